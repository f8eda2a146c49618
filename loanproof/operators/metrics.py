"""Discrimination, calibration, threshold and subgroup figures of scored rows.

All of them start from *score cells*: positives and negatives per distinct score (and
group). Cells are combined before the shuffle, so tied scores and large groups cost one
row per task. Running totals over the cells are distributed (see ``ordering``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanproof.functions.columns import age_band, bin_number, small_cell
from loanproof.operators.ordering import quantile_map, running_totals
from loanproof.session import small_table

SWEEP = [j / 100 for j in range(5, 96)]
AGE_BANDS = (("19-34", 18, 35), ("35-49", 35, 50), ("50+", 50, 101))


def score_cells(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    y = F.col(target)
    return (
        df.filter(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*groups, F.col(score).alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def ranked_cells(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    """Score cells from the highest score down with running positives and negatives."""
    return rank_cells(score_cells(df, score, target, groups), groups)


def rank_cells(cells: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    return running_totals(cells, "score", {"tp": "pos", "fp": "neg"}, groups, descending=True)


def _ratio(top: Column, bottom: Column) -> Column:
    return top / F.nullif(bottom.cast("double"), F.lit(0.0))


def _or_zero(top: Column, bottom: Column) -> Column:
    """The ratio, and 0 where the bottom is zero (but NULL for no rows at all)."""
    return F.when(bottom == 0, 0.0).otherwise(_ratio(top, bottom))


def auc_of_cells() -> Column:
    """Aggregate over ranked cells: tie-aware area under the ROC curve, NULL for one class."""
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    won = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0))
    return won / F.nullif(pos * neg, F.lit(0.0))


def ap_of_cells() -> Column:
    """Aggregate over ranked cells: step-wise average precision, NULL without positives."""
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return _ratio(F.sum(F.col("pos") * precision), F.sum("pos"))


def brier_of_cells() -> Column:
    p = F.col("score")
    off = F.col("pos") * (1 - p) * (1 - p) + F.col("neg") * p * p
    return _ratio(F.sum(off), F.sum(F.col("pos") + F.col("neg")))


def confusion_of_cells(threshold: Column | float) -> dict[str, Column]:
    flagged = F.col("score") >= threshold
    zero = F.lit(0)
    return {
        "true_negative": F.sum(F.when(flagged, zero).otherwise(F.col("neg"))),
        "false_positive": F.sum(F.when(flagged, F.col("neg")).otherwise(zero)),
        "false_negative": F.sum(F.when(flagged, zero).otherwise(F.col("pos"))),
        "true_positive": F.sum(F.when(flagged, F.col("pos")).otherwise(zero)),
    }


def _metric_columns(threshold: Column | float | None) -> list[Column]:
    pos, neg = F.sum("pos"), F.sum("neg")
    rows = pos + neg
    out = [
        rows.alias("rows"),
        pos.alias("positives"),
        _ratio(pos, rows).alias("positive_rate"),
        _ratio(F.sum(F.col("score") * (F.col("pos") + F.col("neg"))), rows).alias("mean_score"),
        auc_of_cells().alias("roc_auc"),
        ap_of_cells().alias("pr_auc"),
        brier_of_cells().alias("brier_score"),
    ]
    if threshold is None:
        return out
    cm = confusion_of_cells(threshold)
    tn, fp, fn, tp = cm.values()
    return out + [
        _ratio(tp + tn, rows).alias("accuracy"),
        _or_zero(tp, tp + fp).alias("precision"),
        _or_zero(tp, tp + fn).alias("recall"),
        _or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(fp, fp + tn).alias("false_positive_rate"),
        _ratio(tp + fp, rows).alias("flag_rate"),
        *[c.alias(n) for n, c in cm.items()],
    ]


def binary_metrics(
    df: DataFrame,
    score: str,
    target: str,
    threshold: Column | float | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """All metrics of a scored table, one row per group (one row in all without groups)."""
    ranked = ranked_cells(df, score, target, groups)
    return ranked.groupBy(*groups).agg(*_metric_columns(threshold))


def roc_auc(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    return ranked_cells(df, score, target, groups).groupBy(*groups).agg(auc_of_cells().alias("roc_auc"))


def average_precision(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    return ranked_cells(df, score, target, groups).groupBy(*groups).agg(ap_of_cells().alias("pr_auc"))


def hard_label_auc(
    df: DataFrame, score: str, target: str, threshold: Column | float, groups: Sequence[str] = ()
) -> DataFrame:
    """AUC of the 0/1 decisions: the mean of the hit rates of both classes."""
    cells = score_cells(df, score, target, groups)
    tn, fp, fn, tp = confusion_of_cells(threshold).values()
    both = (_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2
    return cells.groupBy(*groups).agg(both.alias("roc_auc_of_decisions"))


def roc_curve(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at each distinct score used as threshold."""
    ranked = ranked_cells(df, score, target, groups)
    return ranked.select(
        *groups,
        F.col("score").alias("threshold"),
        _ratio(F.col("fp"), F.col("fp_all")).alias("false_positive_rate"),
        _ratio(F.col("tp"), F.col("tp_all")).alias("true_positive_rate"),
    )


def pr_curve(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at each distinct score used as threshold."""
    ranked = ranked_cells(df, score, target, groups)
    return ranked.select(
        *groups,
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _ratio(F.col("tp"), F.col("tp_all")).alias("recall"),
    )


def calibration_bins(df: DataFrame, score: str, target: str, bins: int = 5) -> DataFrame:
    """Observed rate and mean score in quantile bins; a bin without rows gives no row."""
    inner = [i / bins for i in range(1, bins)]
    rows = df.filter(F.col(score).isNotNull() & F.col(target).isNotNull())
    edges = quantile_map(rows, [score], inner)[score]
    cuts = [edges[p] for p in inner if edges[p] is not None]
    return rows.groupBy(bin_number(score, cuts, closed="right").alias("bin")).agg(
        F.count("*").alias("rows"),
        F.avg(target).alias("observed_rate"),
        F.avg(score).alias("mean_score"),
    )


def score_histogram(df: DataFrame, score: str, bins: int = 14) -> DataFrame:
    """Equal-width bins from the smallest to the largest score, empty bins included."""
    span = df.agg(F.min(score).alias("a"), F.max(score).alias("b")).first()
    low, high = span["a"], span["b"]
    if low is None:
        return small_table(df.sparkSession, {"bin": "int", "low": "double", "high": "double", "rows": "bigint"}, [])
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col(score) - low) / width), F.lit(bins - 1)).cast("int")
    counted = df.filter(F.col(score).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )


def threshold_sweep(
    df: DataFrame, score: str, target: str, thresholds: Sequence[float] = SWEEP, groups: Sequence[str] = ()
) -> DataFrame:
    """Accuracy and F1 at each threshold.

    Each row falls into one of len(thresholds) + 1 steps; only the counts per step are
    shuffled, and the running sums work on that small table.
    """
    y = F.col(target)
    steps = (
        df.filter(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*groups, bin_number(score, thresholds).alias("step"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )
    cuts = small_table(
        df.sparkSession,
        {"cut": "int", "threshold": "double"},
        [(i + 1, float(t)) for i, t in enumerate(sorted(thresholds))],
    )
    # A threshold flags the steps at or above its own number: at most 92 x 91 small pairs.
    flagged = F.col("step") >= F.col("cut")
    zero = F.lit(0)
    paired = steps.withColumn("cut", F.explode(F.sequence(F.lit(1), F.lit(len(thresholds)))))
    sums = paired.groupBy(*groups, "cut").agg(
        F.sum(F.when(flagged, F.col("pos")).otherwise(zero)).alias("tp"),
        F.sum(F.when(flagged, F.col("neg")).otherwise(zero)).alias("fp"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "p", "n"))
    return sums.join(F.broadcast(cuts), "cut").select(
        *groups,
        "threshold",
        _ratio(tp + n - fp, p + n).alias("accuracy"),
        _or_zero(2 * tp, tp + fp + p).alias("f1"),
    )


def best_threshold(sweep: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The threshold with best accuracy, then best F1, then the lowest, per segment."""
    best = F.max_by(
        F.struct("threshold", "accuracy", "f1"), F.struct("accuracy", "f1", -F.col("threshold"))
    )
    return sweep.groupBy(*groups).agg(best.alias("b")).select(*groups, "b.*")


def recall_threshold(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    """The largest cutoff that still flags every positive row."""
    positives = df.filter(F.col(target) == 1)
    return positives.groupBy(*groups).agg(F.min(score).alias("threshold"))


def subgroup_age(
    df: DataFrame, score: str, target: str, threshold: Column | float, age: str = "age", bands=AGE_BANDS
) -> DataFrame:
    """Metrics per age band; a band without rows keeps its row with missing metrics."""
    banded = df.withColumn("age_band", age_band(age, bands)).filter(F.col("age_band").isNotNull())
    found = binary_metrics(banded, score, target, threshold, ["age_band"])
    every = small_table(df.sparkSession, {"age_band": "string"}, [(b[0],) for b in bands])
    out = every.join(found, "age_band", "left")
    for c in ("rows", "positives", "true_negative", "false_positive", "false_negative", "true_positive"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    return out


def subgroup_extended(
    df: DataFrame, score: str, target: str, threshold: Column | float, dimensions: Sequence[str]
) -> DataFrame:
    """Metrics per level of several dimensions in one pass, with a flag for small cells."""
    pairs = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("level")) for d in dimensions]
    )
    long = df.select(score, target, F.explode(pairs).alias("x")).select(score, target, "x.*")
    long = long.filter(F.col("level").isNotNull())
    found = binary_metrics(long, score, target, threshold, ["dimension", "level"])
    return found.select(
        "dimension", "level", "rows", "positives", "positive_rate", "mean_score", "flag_rate", "roc_auc",
        small_cell("rows", "positives").alias("readable"),
    )


def calibration_figures(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    """Observed against expected, and the Brier score against the base rate alone."""
    y, p = F.col(target), F.col(score)
    sums = df.filter(y.isNotNull() & p.isNotNull()).groupBy(*groups).agg(
        F.count("*").alias("rows"),
        F.sum(y).alias("positives"),
        F.avg(y).alias("observed_rate"),
        F.avg(p).alias("mean_score"),
        _ratio(F.sum(p), F.sum(y)).alias("expected_over_observed"),
        F.avg((p - y) * (p - y)).alias("brier_score"),
    )
    base = F.col("observed_rate")
    return sums.withColumn("no_skill_brier", base * (1 - base))


def cv_summary(folds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and sample deviation over folds per grid point, with the folds as an array."""
    detail = F.sort_array(F.collect_list(F.struct("fold", *[c for c in folds.columns if c not in by and c != "fold"])))
    return folds.groupBy(*by).agg(
        F.avg("pr_auc").alias("mean_pr_auc"),
        F.stddev_samp("pr_auc").alias("std_pr_auc"),
        F.avg("roc_auc").alias("mean_roc_auc"),
        F.avg("brier_score").alias("mean_brier_score"),
        detail.alias("fold_detail"),
    )


def seed_summary(runs: DataFrame, by: Sequence[str], metric: str) -> DataFrame:
    return runs.groupBy(*by).agg(
        F.avg(metric).alias(f"mean_{metric}"),
        F.min(metric).alias("seed_minimum"),
        F.max(metric).alias("seed_maximum"),
        F.count(metric).alias("seeds"),
    )


def tolerance_select(grid: DataFrame, segment: Sequence[str] = (), tolerance: float = 0.01) -> DataFrame:
    """Marks per segment the grid point to use: among those within the tolerance of the best
    mean average precision, the lowest mean Brier score, then the smallest C.
    """
    seg = Window.partitionBy(*segment)
    near = F.col("mean_pr_auc") >= F.max("mean_pr_auc").over(seg) - tolerance
    ranked = grid.withColumn("_near", near)
    order = Window.partitionBy(*segment, "_near").orderBy("mean_brier_score", "C", "class_weight")
    place = F.row_number().over(order)
    return ranked.withColumn("selected", F.col("_near") & (place == 1)).drop("_near")


def champion_select(results: DataFrame, segment: Sequence[str], order_column: str) -> DataFrame:
    """The best model per segment: accuracy, then AUC of decisions, then input order."""
    cols = [c for c in results.columns if c not in segment]
    best = F.max_by(F.struct(*cols), F.struct("accuracy", "roc_auc_of_decisions", -F.col(order_column)))
    return results.groupBy(*segment).agg(best.alias("b")).select(*segment, "b.*")


def top_features(relevance: DataFrame, segment: Sequence[str] = (), keep: int = 35) -> DataFrame:
    """The most relevant features per segment, names breaking ties."""
    order = Window.partitionBy(*segment).orderBy(F.col("mutual_information").desc(), "feature")
    return relevance.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
