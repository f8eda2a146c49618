"""The nearest rows: visits in rounds, and what the screen leaves behind."""

from __future__ import annotations

import math

import numpy as np
import pytest

from loanproof.operators import neighbours, population


def cloud(spark, n=600, width=6):
    x = np.random.default_rng(12).normal(size=(n, width)).round(3)
    x[n // 2 : n // 2 + 20] = x[:20]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, " + ", ".join(f"x{i} double" for i in range(width)))
    return x, df


def test_visits_go_in_rounds_of_regions(spark, monkeypatch):
    x, df = cloud(spark)
    turns, real = [], neighbours._visit_kernel
    monkeypatch.setattr(neighbours, "_visit_kernel", lambda tree, counted, *turn: turns.extend(turn) or real(tree, counted, *turn))
    found = neighbours.nearest_other_distance(df, "id", box_points=10, visits=25, region_points=40).collect()
    rounds = turns[0][0]
    assert 1 < rounds <= neighbours.MOST_ROUNDS and turns == [(rounds, k) for k in range(rounds)]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    for r in found:
        assert r["distance"] == pytest.approx(d[r["point"]].min(), abs=1e-12)


def test_screen_leaves_no_shuffle_to_its_reader(spark):
    x, df = cloud(spark)
    fields = [f"x{i}" for i in range(x.shape[1])]
    survivors = population.dedup_keep_first(df, fields, "id")
    made = neighbours.near_duplicate_screen(df, survivors, fields, "id", population.duplicate_pairs(df, fields), region_points=100)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "RDD" not in plan
    found = {r["check"]: r["value"] for r in made.collect()}
    assert found["exact_duplicate_pairs"] == 20.0 and found["rows_within_0_01"] == 40.0
    assert found["rows_within_0_10_after_removal"] < 40.0 and not math.isnan(found["median_nearest_distance"])
