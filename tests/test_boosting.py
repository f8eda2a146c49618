"""Boosted trees in one task and by jobs, against MLlib's."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from loanproof.operators import boosting, models
from loanproof.plans import attribution
from loanproof.schema import LOAN_BOOK
from loanproof.session import materialize, materialize_packed


def made(spark, n, target="y"):
    rng = np.random.default_rng(21)
    x = rng.normal(size=(n, 4)).round(2)
    x[:, 1], x[:, 2] = x[:, 1] > 0.4, np.maximum(x[:, 2], 0)
    y = x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) > 1
    rows = [(*map(float, r), int(v)) for r, v in zip(x, y)]
    rows += rows[: n // 3]  # equal rows count each time
    return materialize(spark.createDataFrame(rows, f"a double, b double, c double, d double, {target} int").repartition(3))


@pytest.mark.parametrize("n, rounds", [(400, 6), (9000, 2)])  # beyond 10,000 rows MLlib draws some to place the bins
def test_trees_are_those_of_mllib(spark, n, rounds):
    df = made(spark, n)
    want = models.boosted_model(df, list("abcd"), "y", rounds=rounds, step=0.3).score(df, "want")
    found = models.boosted_trees(df, list("abcd"), "y", rounds=rounds, step=0.3).score(want, "found")
    far = found.agg(F.max(F.abs(F.col("want") - F.col("found")))).first()[0]
    assert far < 1e-7


def test_one_task_and_jobs_grow_the_same_trees(spark, monkeypatch):
    df = made(spark, 500)
    monkeypatch.setattr(boosting, "KEPT", 2)
    one, many = (boosting.fit_boosted(df, list("abcd"), "y", 5, 0.3, 3, 7, small) for small in (boosting.SMALL, 0))
    for a, b in zip(one.trees, many.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.value == b.value).all()


def test_a_group_of_equal_rows_without_cuts_is_one_leaf(spark):
    df = materialize(spark.createDataFrame([(0.0, 1), (0.0, 0), (0.0, 1)], "a double, y int"))
    model = models.boosted_trees(df, ["a"], "y", rounds=2)
    assert all(t.feature[0] == -1 for t in model.trees)
    assert model.trees[0].value[0] == pytest.approx(1 / 3)


def test_missing_features_and_labels_raise(spark):
    for row in ((None, 1), (float("nan"), 1), (2.0, None), (2.0, 3)):
        df = materialize(spark.createDataFrame([(0.0, 1), (1.0, 0), row], "a double, y int"))
        with pytest.raises(Exception, match="boosted trees"):
            models.boosted_trees(df, ["a"], "y", rounds=1)


def test_study_fits_take_no_jobs_per_round(spark, monkeypatch):
    rows = made(spark, 300, LOAN_BOOK.target).withColumn("part", F.when(F.rand(3) < 0.7, "train").otherwise("test"))
    rows = materialize(rows)
    monkeypatch.setattr(GBTClassifier, "_fit", lambda *_: pytest.fail("the study went through MLlib's jobs"))
    context = spark.sparkContext
    context.setJobGroup("study fit", "jobs of one variant")
    try:
        found = attribution._run(rows, ["a", "b", "c"], LOAN_BOOK, 60).first()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found["test_rows"] == rows.filter("part = 'test'").count()
    assert len(context.statusTracker().getJobIdsForGroup("study fit")) < 60


def test_packed_rows_keep_place_and_order(spark):
    df = spark.range(0, 1000, 1, 3).select("id", (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 5 != 0, "t").alias("s"), F.lit("2020-01-02").cast("date").alias("d"))
    spot = [F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")]
    kept = materialize_packed(df)
    assert kept.schema == df.schema
    assert kept.select("*", *spot).collect() == df.select("*", *spot).collect()
    assert materialize_packed(df.filter("id < 0")).count() == 0
