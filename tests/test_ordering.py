"""Positions, running totals, quantiles, splits and folds against plain Python."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanproof.operators import metrics, ordering, population
from loanproof.schema import APPS


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(5)
    # A third of the rows share one value; one column is all missing.
    rows = [(i, 1.5 if i % 3 == 0 else rng.gauss(0, 1), float(i % 7) if i % 5 else None, None) for i in range(3000)]
    return spark.createDataFrame(rows, "id int, a double, b double, empty double").cache()


@pytest.mark.parametrize("parts", [1, 13])
def test_exact_quantiles(numbers, parts):
    probs = [0.0, 0.01, 0.25, 0.5, 0.6667, 0.99, 1.0]
    found = ordering.quantile_map(numbers.repartition(parts), ["a", "b", "empty"], probs)
    data = numbers.toPandas()
    for c in ("a", "b"):
        for p in probs:
            assert found[c][p] == pytest.approx(np.quantile(data[c].dropna(), p), abs=1e-12)
    assert set(found["empty"].values()) == {None}


def test_quantiles_of_extreme_values(spark):
    """Neighbouring doubles, both zeros, infinities and NaN keep their order to the last bit."""
    tiny = [1.0, float(np.nextafter(1.0, 2.0)), float(np.nextafter(1.0, 0.0)), 5e-324, -5e-324, 0.0, -0.0, -1e308]
    values = [*tiny, float("inf"), float("-inf"), float("nan")] * 3
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "x double")
    want = sorted(v for v in values if v == v)
    n = len(values)  # 33: positions i / 32 are exact
    found = ordering.quantile_map(df, ["x"], [i / (n - 1) for i in range(n)])["x"]
    for i in range(n):
        got = found[i / (n - 1)]
        assert got == want[i] if i < len(want) else got != got


def test_quantiles_of_few_rows(spark):
    one = spark.createDataFrame([(4.0,)], "x double")
    assert ordering.quantile_map(one, ["x"], [0.1, 0.9])["x"] == {0.1: 4.0, 0.9: 4.0}
    none = spark.createDataFrame([], "x double")
    assert ordering.quantile_map(none, ["x"], [0.5])["x"] == {0.5: None}


@pytest.mark.parametrize("width", ["1", "8"])
def test_ordinal_does_not_depend_on_partitions(spark, numbers, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ordering.row_ordinal(numbers.select("a", "id"), ["a", "id"]).collect()
        cells = numbers.groupBy("b", "a").agg(F.count("*").alias("n"))
        totals = ordering.running_totals(cells, "a", {"cum": "n"}, ["b"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted((r["a"], r["id"]) for r in numbers.collect())
    assert [(r["a"], r["id"]) for r in sorted(found, key=lambda r: r["ordinal"])] == want
    assert sorted(r["ordinal"] for r in found) == list(range(3000))
    for b in (None, 1.0, 6.0):
        mine = sorted((r for r in totals if r["b"] == b), key=lambda r: r["a"])
        sums = np.cumsum([r["n"] for r in mine])
        assert [r["cum"] for r in mine] == sums.tolist()
        assert {r["cum_all"] for r in mine} == {sums[-1]}


def test_keys_at_positions_inside_a_hot_day(spark):
    day = dt.date(2020, 1, 5)
    rows = [(i, day if i % 3 == 0 else dt.date(2020, 1, 1) + dt.timedelta(days=i % 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "app_id int, application_date date")
    order = sorted((d, i) for i, d in rows)
    spots = [0, 150, 200, 201, 399, 400]
    found = ordering.keys_at_positions(df, "application_date", ["application_date", "app_id"], lambda n: spots)
    assert found == [order[p] if p < 400 else None for p in spots]


def test_split_keeps_days_whole(spark):
    days = [dt.date(2021, 1, 1) + dt.timedelta(days=d) for d in range(10)]
    # The boundary day holds many rows.
    rows = [(i, 1, days[min(i // 5, 6)] if i < 45 else days[7 + i % 3], 1) for i in range(60)]
    df = spark.createDataFrame(rows, "app_id int, customer_id int, application_date date, default_12m int")
    dates = sorted(r[2] for r in rows)
    want = [dates[math.ceil(59 * q)] for q in (0.6, 0.8)]
    assert population.split_dates(df, APPS) == want
    split = population.chronological_split(df, APPS)
    per_day = split.groupBy("application_date").agg(F.countDistinct("split").alias("n"))
    assert per_day.filter("n > 1").count() == 0
    assert split.count() == 60
    with pytest.raises(ValueError, match="customers occur"):
        population.check_partitions(split, APPS)


def test_partition_without_positive_rows_is_refused(spark):
    rows = [(i, i, dt.date(2021, 1, 1) + dt.timedelta(days=i), int(i < 30)) for i in range(60)]
    df = spark.createDataFrame(rows, "app_id int, customer_id int, application_date date, default_12m int")
    with pytest.raises(ValueError, match="no positive row"):
        population.check_partitions(population.chronological_split(df, APPS), APPS)


def test_folds_as_published(spark):
    rows = [(i, dt.date(2021, 1, 1) + dt.timedelta(days=i // 3), int(i % 40 == 0)) for i in range(471)]
    df = spark.createDataFrame(rows, "app_id int, application_date date, default_12m int")
    blocked = population.fold_block(df, APPS)
    found = population.time_series_folds(blocked, APPS).orderBy("fold").collect()
    assert [r["train_rows"] for r in found] == [120, 237, 354]
    assert [r["validation_rows"] for r in found] == [117, 117, 117]
    last = blocked.groupBy("block").agg(F.min("app_id").alias("a"), F.max("app_id").alias("b")).orderBy("block").collect()
    for early, late in zip(last, last[1:]):
        assert early["b"] < late["a"]
    with pytest.raises(ValueError, match="too few"):
        population.fold_block(df.limit(2), APPS)


def test_auc_properties(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0.1, 0.2, 0.3, 0.35]) if i % 2 else rng.random(), int(rng.random() < 0.2)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, p double, y int")
    auc = metrics.roc_auc(df, "p", "y").first()[0]
    pairs = [(a, b) for _, a, ya in rows if ya for _, b, yb in rows if not yb]
    assert auc == pytest.approx(sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs))
    moved = df.withColumn("p", F.exp(3 * F.col("p")) - 7)
    assert metrics.roc_auc(moved, "p", "y").first()[0] == pytest.approx(auc)
    turned = df.withColumn("p", -F.col("p"))
    assert metrics.roc_auc(turned, "p", "y").first()[0] == pytest.approx(1 - auc)


def test_one_class_and_empty_groups(spark):
    df = spark.createDataFrame([(0.2, 0, 20), (0.2, 0, 40), (0.9, 0, 17)], "p double, y int, age int")
    row = metrics.binary_metrics(df, "p", "y", 0.5).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    bands = {r["age_band"]: r for r in metrics.subgroup_age(df, "p", "y", 0.5).collect()}
    assert bands["50+"]["rows"] == 0 and bands["50+"]["brier_score"] is None
    assert bands["19-34"]["rows"] == 1
    same = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 0)], "p double, y int")
    assert metrics.roc_auc(same, "p", "y").first()[0] == 0.5
    assert sum(r["rows"] for r in metrics.score_histogram(same, "p").collect()) == 3
