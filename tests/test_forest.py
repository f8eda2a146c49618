"""Forests kept as rows: same trees wherever a top ends, and nothing of them in the driver but tops."""

from __future__ import annotations

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanproof.operators import forest, models

NAMES = list("abcd")


@pytest.fixture(scope="module")
def loans(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(1200, 4))
    x[:, 2], x[:, 3] = np.round(x[:, 2]), x[:, 3] > 1
    y = rng.random(1200) < 1 / (1 + np.exp(1 - 2 * x[:, 0] * x[:, 1] - x[:, 2]))
    rows = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y int").repartition(3, "id").cache()


def scores(model, rows) -> list[float]:
    return [r["score"] for r in model.score(rows).orderBy("id").collect()]


def test_tops_and_rounds_do_not_change_the_trees(loans):
    train, test = loans.filter("id < 800"), loans.filter("id >= 800")
    whole = forest.fit_forest(train, NAMES, "y", 12, 30, 7)
    cut = forest.fit_forest(train, NAMES, "y", 12, 30, 7, small=60, abreast=5)
    assert [len(r.trees) for r in cut.rounds] == [5, 5, 2]
    assert len(whole.rounds[0].top) == 12 and all(len(r.top) > 3 * len(r.trees) for r in cut.rounds)
    assert scores(cut, test) == pytest.approx(scores(whole, test), abs=1e-12)
    assert scores(forest.fit_forest(train.repartition(5), NAMES, "y", 12, 30, 7), test) == pytest.approx(scores(whole, test), abs=1e-12)
    flat = forest.fit_forest(train, NAMES, "y", 12, 3, 7)
    assert scores(forest.fit_forest(train, NAMES, "y", 12, 3, 7, small=60), test) == pytest.approx(scores(flat, test), abs=1e-12)
    assert max(len(r["nodes"]) for r in flat.rounds[0].below.collect()) <= 15 * forest._NODE.itemsize


def test_driver_keeps_tops_only(loans):
    model = models.forest_model(loans, NAMES, "y", trees=9, seed=3)
    held = sum(len(r.top) for r in model.rounds)
    nodes = sum(len(r["nodes"]) // forest._NODE.itemsize for one in model.rounds for r in one.below.collect())
    assert held == 9 and nodes > 9 * 100
    assert inspect.signature(models.forest_model).parameters["trees"].default == 500


def test_learns_as_well_as_mllib(spark, loans):
    from pyspark.ml.classification import RandomForestClassifier

    train, test = loans.filter("id < 800"), loans.filter("id >= 800")
    label = np.array([r["y"] for r in test.orderBy("id").collect()])

    def auc(found):
        a, b = np.array(found)[label == 1], np.array(found)[label == 0]
        return (a[:, None] > b).mean() + (a[:, None] == b).mean() / 2

    mllib = RandomForestClassifier(numTrees=60, maxDepth=30, featureSubsetStrategy="sqrt", seed=7)
    want = auc(scores(models._fit_vector_model(mllib, train, NAMES, "y"), test))
    assert auc(scores(models.forest_model(train, NAMES, "y", trees=60), test)) == pytest.approx(want, abs=0.03)


def gini(y: np.ndarray) -> float:
    return 2 * y.mean() * (1 - y.mean()) * len(y)


def test_splits_against_brute_force():
    rng = np.random.default_rng(4)
    bins, y, weight = rng.integers(0, 5, (60, 3)).astype(np.uint8), rng.integers(0, 2, 60).astype(np.uint8), rng.integers(1, 4, 60).astype(np.uint8)
    how = forest.Growth(3, 3, 5, 2)
    (nodes,) = forest.grow(how, bins, y, weight, np.zeros(60, int), forest.roots(1, range(1)), np.zeros(1, int))
    root = np.frombuffer(nodes, forest._NODE)[0]
    line, label = np.repeat(bins, weight, axis=0), np.repeat(y, weight)
    cost = {}
    for k in range(3):
        for cut in range(4):
            left = line[:, k] <= cut
            if 0 < left.sum() < len(left):
                cost[k, cut] = gini(label[left]) + gini(label[~left])
    assert cost[root["feature"], root["cut"]] == pytest.approx(min(cost.values()))


def test_cuts(spark):
    """A level of few rows keeps its cut; a value that holds most rows is parted from both sides."""
    rows = [(float(i == 7), 5.0 if i % 50 else i / 1000, float(i)) for i in range(2000)]
    few, heavy, many = forest.bin_edges(spark.createDataFrame(rows, "few double, heavy double, many double").repartition(4), ["few", "heavy", "many"])
    assert few.tolist() == [0.5]
    assert any(1.95 <= c < 5 for c in heavy) and len(heavy) < forest.MAX_BINS
    assert len(many) == 31


def test_odd_rows(spark, loans):
    with pytest.raises(Exception, match="missing"):
        models.forest_model(loans.withColumn("a", F.when(F.col("id") != 5, F.col("a"))), NAMES, "y", trees=2)
    with pytest.raises(Exception, match="target"):
        models.forest_model(loans.withColumn("y", F.lit(None).cast("int")), NAMES, "y", trees=2)
    with pytest.raises(ValueError, match="rows"):
        models.forest_model(loans.filter("false"), NAMES, "y", trees=2)
    model = models.forest_model(loans.unionByName(loans), NAMES, "y", trees=2)
    assert model.score(loans.filter("false")).count() == 0
    twice = model.score(loans.unionByName(loans).withColumn("score", F.lit("old")))
    assert twice.count() == 2400 and twice.groupBy("id").agg(F.count_distinct("score").alias("n")).agg(F.max("n")).first()[0] == 1
    assert twice.columns == [*loans.columns, "score"]


def test_equal_rows_go_down_as_one_line(loans, monkeypatch):
    """Runs of equal rows have at most 16 rows, lose none, and fewer lines are walked than there are rows."""
    bins, y = np.repeat(np.array([[1, 2], [1, 3], [1, 3]], np.uint8), [40, 3, 2], axis=0), np.repeat(np.array([0, 1, 0], np.uint8), [40, 3, 2])
    assert forest.runs(bins, y).tolist() == [0, 16, 32, 40, 43]
    assert forest._POISSON.max() * 16 <= 255
    copies = loans.filter("id < 300").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40))))
    test = loans.filter("id >= 800")
    few = scores(forest.fit_forest(copies, NAMES, "y", 6, 30, 7, small=500), test)
    monkeypatch.setattr(forest, "runs", lambda bins, y: np.arange(len(y)))
    assert few == pytest.approx(scores(forest.fit_forest(copies, NAMES, "y", 6, 30, 7, small=500), test), abs=1e-12)
