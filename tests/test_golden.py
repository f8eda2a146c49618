"""Published figures recomputed from the published record-level scores."""

from __future__ import annotations

import pytest
from golden_rows import THRESHOLD
from pyspark.sql import functions as F

from loanproof.operators import metrics, models, sampling

Y, P = "default_12m", "score"


def close(a, b, tol=1e-9):
    if b is None:
        assert a is None
    else:
        assert a == pytest.approx(b, abs=tol)


def test_binary_metrics(golden):
    row = metrics.binary_metrics(golden, P, Y, THRESHOLD).first()
    close(row["roc_auc"], 0.8785871964679911)
    close(row["pr_auc"], 0.22762754450530603)
    close(row["brier_score"], 0.05265635399745581)
    close(row["accuracy"], 0.84375)
    close(row["precision"], 0.23333333333333334)
    close(row["recall"], 0.7777777777777778)
    close(row["f1"], 0.358974358974359)
    cells = [row[c] for c in ("true_negative", "false_positive", "false_negative", "true_positive")]
    assert cells == [128, 23, 2, 7]


def test_subgroup_age(golden):
    found = {r["age_band"]: r for r in metrics.subgroup_age(golden, P, Y, THRESHOLD).collect()}
    # Rows, positives, mean score, AUC, AP, Brier, flag rate, precision, recall, FPR.
    want = {
        "19-34": (47, 0, 0.02110331925397052, None, None, 0.002394493480462502, 0.1702127659574468, 0.0, 0.0, 0.1702127659574468),
        "35-49": (70, 6, 0.020995760337583734, 0.8802083333333333, 0.31209415584415584, 0.08033707471984029, 0.17142857142857143, 0.3333333333333333, 0.6666666666666666, 0.125),
        "50+": (43, 3, 0.02048271959683027, 0.9333333333333333, 0.5873015873015872, 0.06253209803772955, 0.23255813953488372, 0.3, 1.0, 0.175),
    }
    names = ("rows", "positives", "mean_score", "roc_auc", "pr_auc", "brier_score", "flag_rate", "precision", "recall", "false_positive_rate")
    for band, values in want.items():
        for name, value in zip(names, values):
            close(found[band][name], value)


def test_subgroup_extended(golden):
    found = {r["level"]: r for r in metrics.subgroup_extended(golden, P, Y, THRESHOLD, ["state"]).collect()}
    # Rows, positives, flag rate, AUC per state.
    want = {
        "CA": (26, 3, 0.2692307692307692, 0.7826086956521738),
        "FL": (19, 2, 0.2631578947368421, 0.9117647058823529),
        "GA": (11, 0, 0.09090909090909091, None),
        "IL": (10, 1, 0.1, 1.0),
        "MA": (10, 0, 0.2, None),
        "NC": (8, 0, 0.0, None),
        "NJ": (13, 1, 0.07692307692307693, 1.0),
        "NY": (20, 1, 0.3, 0.4736842105263158),
        "OH": (13, 0, 0.07692307692307693, None),
        "PA": (10, 1, 0.5, 0.5555555555555556),
        "TX": (10, 0, 0.0, None),
        "VA": (10, 0, 0.1, None),
    }
    assert set(found) == set(want)
    for state, values in want.items():
        for name, value in zip(("rows", "positives", "flag_rate", "roc_auc"), values):
            close(found[state][name], value)
        assert found[state]["readable"] == "no, cell too small"


def test_calibration(golden):
    row = models.calibration_summary({"final": golden}, P, Y).first()
    close(row["expected_over_observed"], 0.37136846347013086)
    close(row["mean_score"], 0.02088947607019486)
    close(row["no_skill_brier"], 0.0530859375)
    close(row["calibration_intercept"], 1.1177600649619162, 1e-3)
    close(row["calibration_slope"], 0.9928253627039426, 1e-3)


# Published intervals of the final sample.
INTERVALS = {
    "roc_auc": (0.8013245033112583, 0.9403973509933775),
    "pr_auc": (0.1575594395165474, 0.43600290958134086),
    "brier_score": (0.050409868555195386, 0.05522247151802839),
}


def test_bootstrap_intervals(golden):
    found = {r["metric"]: r for r in sampling.bootstrap_ci(golden, P, Y, "row_id", 2000, 42).collect()}
    for metric, (low, high) in INTERVALS.items():
        close(found[metric]["ci_low"], low, 0.01)
        close(found[metric]["ci_high"], high, 0.02)


@pytest.mark.parametrize("parts", ["1", "8"])
def test_count_tree_intervals(spark, golden, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = {r["metric"]: r for r in sampling.bootstrap_tree(golden, P, Y).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for metric, (low, high) in INTERVALS.items():
        close(found[metric]["ci_low"], low, 0.01)
        close(found[metric]["ci_high"], high, 0.025 if metric == "pr_auc" else 0.01)  # 9 positives: the end moves by 0.01 with the seed


def test_count_tree_keeps_class_totals():
    sizes = [3, 0, 40, 7, 0, 950]
    parts = [sampling.block_draws(sizes, k, 500, 42, 1) for k in range(len(sizes))]
    assert (sum(here for here, _ in parts) == sum(sizes)).all()
    running = 0
    for size, (here, before) in zip(sizes, parts):
        assert (before == running).all() and (size or not here.any())
        assert abs(here.mean() - size) <= 4 * max(1, size) ** 0.5 / 500**0.5
        running = running + here


def test_bootstrap_of_one_class(spark):
    rows = spark.createDataFrame([(0.1, 0), (0.2, 0), (None, 1), (0.3, None)], "p double, y int")
    found = {r["metric"]: r["ci_low"] for r in sampling.bootstrap_tree(rows, "p", "y", 50).collect()}
    assert found.get("roc_auc") is None and found.get("pr_auc") is None and 0.01 <= found["brier_score"] <= 0.04
    assert not [r for r in sampling.bootstrap_tree(rows.limit(0), "p", "y", 50).collect() if r["ci_low"] is not None]


# AP, AUC and Brier score per fold of each grid point, and the published
# mean AP, deviation of AP, mean AUC and mean Brier score.
GRID = [
    (0.01, "None", [(0.017371033238080917, 0.2739130434782609, 0.1190821719517434), (0.030776515151515152, 0.591304347826087, 0.09618423379409938), (0.06857031857031858, 0.7690058479532164, 0.06178518435189013)], (0.03890595565330488, 0.026550095231224237, 0.5447410797525215, 0.09235053003257764)),
    (0.1, "None", [(0.016273849607182943, 0.23043478260869565, 0.03289126092657826), (0.06428571428571428, 0.8, 0.07519257924879857), (0.06818070818070818, 0.7690058479532165, 0.027064186067981756)], (0.049580090691201804, 0.02890972182018705, 0.5998135435206374, 0.04504934208111953)),
    (1.0, "None", [(0.017318124913061624, 0.2739130434782609, 0.02353194934221395), (0.18253968253968253, 0.9434782608695652, 0.4008788205980967), (0.056115779645191405, 0.6695906432748537, 0.02614506314799947)], (0.08532452903264519, 0.08639678267578031, 0.6289939825408933, 0.15018527769610338)),
    (10.0, "None", [(0.01922739244951712, 0.3521739130434782, 0.043258191970127376), (0.22619047619047616, 0.9565217391304348, 0.531358480360724), (0.037106960835774395, 0.5438596491228069, 0.02749652097304235)], (0.09417494315858922, 0.11467778975324576, 0.6175184337655734, 0.20070439776796456)),
]


def test_grid_summary_and_choice(spark):
    rows = [(c, w, i + 1, *m) for c, w, folds, _ in GRID for i, m in enumerate(folds)]
    folds = spark.createDataFrame(rows, "C double, class_weight string, fold int, pr_auc double, roc_auc double, brier_score double")
    table = metrics.tolerance_select(metrics.cv_summary(folds, ["C", "class_weight"]))
    found = {r["C"]: r for r in table.collect()}
    for c, _, _, want in GRID:
        for name, value in zip(("mean_pr_auc", "std_pr_auc", "mean_roc_auc", "mean_brier_score"), want):
            close(found[c][name], value)
        assert [d["fold"] for d in found[c]["fold_detail"]] == [1, 2, 3]
    assert [c for c, r in found.items() if r["selected"]] == [1.0]


def test_recall_threshold_and_sweep(golden):
    top = metrics.recall_threshold(golden, P, Y).first()["threshold"]
    assert golden.filter((F.col(Y) == 1) & (F.col(P) < top)).count() == 0
    sweep = {round(r["threshold"], 2): r for r in metrics.threshold_sweep(golden, P, Y).collect()}
    assert len(sweep) == 91
    rows = [(r[Y], r[P]) for r in golden.collect()]
    for t in (0.05, 0.29, 0.57, 0.95):
        right = sum((p >= t) == (y == 1) for y, p in rows)
        close(sweep[t]["accuracy"], right / len(rows))
