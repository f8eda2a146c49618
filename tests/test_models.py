"""Fits and preparation against direct numerical solutions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanproof.operators import models, neighbours, population, prep, sampling


@pytest.fixture(scope="module")
def loans(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        a, b = float(rng.normal()), float(rng.normal())
        kind = ["x", "y", "z"][int(rng.integers(3))]
        y = int(rng.random() < 1 / (1 + np.exp(2 - a + 0.5 * b)))
        rows.append((i, None if i % 17 == 0 else a, b, None if i % 23 == 0 else kind, y))
    return spark.createDataFrame(rows, "id int, a double, b double, kind string, y int").cache()


def newton(x: np.ndarray, y: np.ndarray, w: np.ndarray, c: float) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        grad = beta + c * x.T @ (w * (p - y))
        hess = np.eye(len(beta)) + c * (x * (w * p * (1 - p))[:, None]).T @ x
        beta -= np.linalg.solve(hess, grad)
    return beta


@pytest.mark.parametrize("weight", [None, "balanced"])
@pytest.mark.parametrize("c", [0.1, 10.0])
def test_logistic_equals_newton(loans, c, weight):
    learned = prep.train_only_preparation(loans, ["a", "b"], ["kind"])
    wide = learned.transform(loans, ["id", "y"])
    model = models.logistic_l2(wide, learned.names, "y", c, weight)
    data = wide.toPandas()
    x = np.column_stack([data[learned.names].to_numpy(), np.ones(len(data))])
    y = data["y"].to_numpy()
    w = np.ones(len(y)) if weight is None else np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    want = newton(x, y, w, c)
    assert np.allclose([*model.coefficients, model.intercept], want, atol=1e-8)


def test_fits_of_several_groups_together(loans):
    """Each point sees its own group's rows only; a free intercept is not shrunk."""
    learned = prep.train_only_preparation(loans, ["a", "b"], ["kind"])
    wide = learned.transform(loans, ["id", "y"])
    rows = models.fit_rows(wide, learned.names, "y", F.col("id") % 2)
    points = [models.FitPoint(g, c) for g in (0, 1) for c in (0.1, 100.0)] + [models.FitPoint(1, 1.0, (1.0, 3.0))]
    betas = models.newton_fits(rows, points, len(learned.names) + 1)
    data = wide.toPandas()
    for point, beta in zip(points, betas):
        mine = data[data["id"] % 2 == point.group]
        x = np.column_stack([mine[learned.names].to_numpy(), np.ones(len(mine))])
        y = mine["y"].to_numpy()
        assert np.allclose(beta, newton(x, y, np.where(y == 1, point.weights[1], point.weights[0]), point.c_value), atol=1e-7)
    (free,) = models.unpenalized_intercept_logistics(wide, learned.names, "y", [1.0])
    p = 1 / (1 + np.exp(-(data[learned.names].to_numpy() @ np.array(free.model.coefficients) + free.model.intercept)))
    assert p.sum() == pytest.approx(data["y"].sum(), abs=1e-6)


def test_fit_of_one_class_raises(loans):
    with pytest.raises(ValueError, match="both classes"):
        models.logistic_l2(loans.filter("y = 0"), ["b"], "y")


def test_preparation_reads_only_the_fitted_rows(loans):
    train, test = loans.filter("id < 300"), loans.filter("id >= 300")
    learned = prep.train_only_preparation(train, ["a", "b"], ["kind"])
    changed = test.withColumn("a", F.col("a") * 100).unionByName(train)
    again = prep.train_only_preparation(changed.filter("id < 300"), ["a", "b"], ["kind"])
    assert learned == again
    data = train.toPandas()
    assert learned.medians["a"] == pytest.approx(data["a"].median())
    assert learned.flagged == ("a",)
    assert learned.modes["kind"] == data["kind"].value_counts().sort_index().idxmax()
    filled = data["a"].fillna(data["a"].median())
    assert learned.scales["a"] == pytest.approx((filled.mean(), filled.std(ddof=0)))


def test_unseen_level_and_constant_column(spark):
    train = spark.createDataFrame([(1, 2.0, "x", 0), (2, 2.0, "y", 1)], "id int, a double, kind string, y int")
    test = spark.createDataFrame([(3, 5.0, "new", 0), (4, None, None, 0)], "id int, a double, kind string, y int")
    learned = prep.train_only_preparation(train, ["a"], ["kind"])
    rows = {r["id"]: r for r in learned.transform(test, ["id"]).collect()}
    assert (rows[3]["kind_x"], rows[3]["kind_y"]) == (0.0, 0.0)
    assert rows[4]["kind_x"] == 1.0  # equal counts: the smaller level fills
    assert rows[3]["a"] == 3.0 and rows[4]["a"] == 0.0
    rates = prep.target_encode(test, "kind", "y", train).collect()
    assert {r["kind_target_rate"] for r in rates} == {0.5}


def test_infinite_cells_are_filled(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("inf")), (3, 3.0), (4, float("nan"))], "id int, a double")
    learned = prep.fit_preparation(df, ["a"], [])
    assert learned.medians["a"] == 2.0 and learned.flagged == ("a",)


def test_mutual_information(spark):
    df = spark.createDataFrame([(float(i), float(i % 2), i % 2) for i in range(200)], "noise double, same double, y int")
    found = {r["feature"]: r["mutual_information"] for r in prep.mutual_information(df, ["noise", "same"], "y").collect()}
    assert found["same"] == pytest.approx(np.log(2))
    assert found["noise"] < 0.01


def test_oversampling_and_contamination(spark, loans):
    from loanproof.schema import APPS

    thin = loans.select(F.col("id").alias("app_id"), F.col("y").alias("default_12m"))
    early = sampling.oversample_then_split(thin, APPS, 3)
    sizes = {r["default_12m"]: r["n"] for r in early.groupBy("default_12m").agg(F.count("*").alias("n")).collect()}
    assert sizes[0] == sizes[1]
    total = sizes[0] + sizes[1]
    assert early.filter("part = 'test'").count() == -(-total // 4)
    dirty = population.train_test_contamination(early, "source_row_id", "part", "default_12m").first()
    assert dirty["contaminated_rows"] > 0
    late = sampling.split_then_oversample(thin, APPS, 3)
    clean = population.train_test_contamination(late, "source_row_id", "part", "default_12m").first()
    assert clean["contaminated_rows"] == 0
    balanced = thin.withColumn("default_12m", F.lit(1))
    assert sampling.oversample_minority(balanced, "default_12m", "app_id", 3).count() == thin.count()


def brute(points: np.ndarray) -> np.ndarray:
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return d.min(1)


@pytest.mark.parametrize("box", [5, 40, 5000])
def test_nearest_other_row(spark, box):
    rng = np.random.default_rng(8)
    cloud = rng.normal(size=(250, 4))
    # Dense knot, exact copies, a column of few values and one far point.
    cloud[:80] = cloud[0] + rng.normal(scale=0.01, size=(80, 4))
    cloud[200:215] = cloud[210]
    cloud[:, 3] = np.round(cloud[:, 3])
    cloud[249] = 50.0
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(cloud)], "id int, x0 double, x1 double, x2 double, x3 double")
    found = neighbours.nearest_other_distance(df, "id", box_points=box, visits=30).collect()
    want = brute(cloud)
    assert sum(r["copies"] for r in found) == 250
    for r in found:
        assert r["distance"] == pytest.approx(want[r["point"]], abs=1e-12)


@pytest.mark.parametrize("reach", [None, 0.3])
def test_nearest_other_row_in_many_regions(spark, reach):
    rng = np.random.default_rng(9)
    cloud = np.round(rng.normal(size=(400, 3)), 2)
    cloud[::7, 1] = 0.0
    rows = [(i, *map(float, r)) for i, r in enumerate(cloud)] + [(900, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id int, x0 double, x1 double, x2 double")
    found = {r["point"]: r for r in neighbours.nearest_other_distance(df, "id", reach, box_points=10, visits=25, region_points=30).collect()}
    assert found.pop(900)["distance"] is None
    for k, want in enumerate(brute(cloud)):
        if k in found and (reach is None or want <= reach):
            assert found[k]["distance"] == pytest.approx(want, abs=1e-12)
        elif k in found:
            assert found[k]["distance"] is None or found[k]["distance"] > reach


def test_visits_are_not_written_per_box(spark, monkeypatch):
    rng = np.random.default_rng(10)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.normal(size=(600, 8)))], "id int, " + ", ".join(f"x{i} double" for i in range(8)))
    written = []
    real = neighbours.materialize
    monkeypatch.setattr(neighbours, "materialize", lambda d: written.append(real(d)) or written[-1])
    assert neighbours.nearest_other_distance(df, "id", box_points=10, region_points=100).count() == 600
    assert max(w.count() for w in written) <= 600


def test_nearest_of_one_row(spark):
    df = spark.createDataFrame([(1, 0.0)], "id int, x0 double")
    assert neighbours.nearest_other_distance(df, "id").first()["distance"] is None


def test_registered_runs_have_full_sizes(spark, folder, monkeypatch):
    import inspect

    from loanproof import queries
    from loanproof.operators import models, sampling
    from loanproof.plans import attribution, validation

    class Reached(Exception):
        pass

    def sizes_of(module, operator, query):
        real = inspect.signature(getattr(module, operator))

        def stop(*a, **b):
            bound = real.bind(*a, **b)
            bound.apply_defaults()
            assert all(bound.arguments[n] == p.default for n, p in real.parameters.items() if n in ("trees", "depth", "rounds", "seeds", "budget", "repetitions", "mode", "c_value") and p.default is not p.empty)
            raise Reached

        monkeypatch.setattr(module, operator, stop)
        with pytest.raises(Reached):
            queries.queries()[query](spark, folder)

    sizes_of(sampling, "bootstrap_ci", "bootstrap_ci")
    sizes_of(attribution, "leakage_2x2", "leakage_2x2")
    sizes_of(attribution, "repair_ladder", "repair_ladder")
    sizes_of(attribution, "faulty_pipeline_replay", "faulty_pipeline_replay")
    sizes_of(validation, "fit_freeze_score", "fit_freeze_score")
    sizes_of(models, "tune", "challengers")
    sizes_of(models, "forest_model", "forest_model")
    sizes_of(models, "boosted_model", "boosted_model")


def test_boosting_keeps_no_node_number_per_row(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(float(a), float(b), int(a + b > 1.1)) for a, b in rng.random((300, 2))]
    train = spark.createDataFrame(rows, "a double, b double, y int")
    kept = []
    real = models._fit_vector_model
    monkeypatch.setattr(models, "_fit_vector_model", lambda e, *rest: kept.append(e.getCacheNodeIds()) or real(e, *rest))
    mine = models.boosted_model(train, ["a", "b"], "y", rounds=3)
    monkeypatch.setattr(models, "BOOST_RUN", models.TREE_RUN)
    before = models.boosted_model(train, ["a", "b"], "y", rounds=3)
    assert kept == [False, True]
    assert mine.model.toDebugString.split("\n")[1:] == before.model.toDebugString.split("\n")[1:]


def test_mutual_information_counts_bins_in_the_tasks(spark):
    """Missing values are a bin of their own, NaN lies above all cuts, and no row is copied per feature."""
    rng = np.random.default_rng(8)
    nan, y = float("nan"), rng.integers(0, 2, 300).tolist()
    a = [None if i % 11 == 0 else nan if i % 13 == 0 else round(float(rng.normal()) + v, 1) for i, v in enumerate(y)]
    rows = [(v, x, int(rng.integers(3))) for v, x in zip(y, a)] + [(None, 0.5, 1)]
    df = spark.createDataFrame(rows, "t int, a double, `b c` int").repartition(3)
    made = prep.mutual_information(df, ["a", "b c"], "t")
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
    cuts = prep.quantile_map(df, ["a", "b c"], [i / 10 for i in range(1, 10)])
    want = {}
    for k, name in enumerate(["a", "b c"], 1):
        edges = {x for x in cuts[name].values() if x == x}
        bins = [None if r[k] is None else len(edges) if r[k] != r[k] else sum(x < r[k] for x in edges) for r in rows[:-1]]
        want[name] = 0.0
        for b in set(bins):
            for side in (0, 1):
                n = sum(x == b and v == side for x, v in zip(bins, y))
                if n:
                    want[name] += n / 300 * np.log(n * 300 / (bins.count(b) * y.count(side)))
    assert {r["feature"]: r["mutual_information"] for r in made.collect()} == pytest.approx(want)
