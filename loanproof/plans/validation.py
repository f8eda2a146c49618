"""The sound design: tune and fit on development, freeze on validation, score the rest once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.functions.columns import above_threshold
from loanproof.operators.metrics import binary_metrics, recall_threshold
from loanproof.operators.models import ScoringPipeline, calibration_summary, fit_pipeline, run_together, tune
from loanproof.operators.population import (
    DEVELOPMENT,
    FINAL,
    VALIDATION,
    check_partitions,
    chronological_split,
    eligible_population,
)
from loanproof.operators.prep import fit_preparation
from loanproof.operators.sampling import bootstrap_tree
from loanproof.schema import ApplicationSchema
from loanproof.session import materialize


def part(split: DataFrame, name: str) -> DataFrame:
    return split.filter(F.col("split") == name)


def split_population(raw: DataFrame, schema: ApplicationSchema, customers: bool = True) -> DataFrame:
    """The eligible population with its time split, written once and checked.

    ``customers`` also demands that no customer is in two partitions.
    """
    eligible = materialize(eligible_population(raw, schema))
    split = chronological_split(eligible, schema)
    check_partitions(split, schema, customers=customers)
    return split


@dataclass(frozen=True)
class FrozenModel:
    pipeline: ScoringPipeline
    threshold: float
    c_value: float
    class_weight: str | None

    def score(self, df: DataFrame) -> DataFrame:
        scored = self.pipeline.score(df)
        return scored.withColumn("threshold", F.lit(self.threshold)).withColumn(
            "predicted", above_threshold("score", self.threshold)
        )


def fit_freeze(
    split: DataFrame, schema: ApplicationSchema, c_value: float, class_weight: str | None = None
) -> FrozenModel:
    """Fit on development rows; the threshold keeps every positive of the validation rows.

    The model is not fitted again on more rows, and the final rows are not read.
    """
    pipeline = fit_pipeline(part(split, DEVELOPMENT), schema, c_value, class_weight)
    validation = pipeline.score(part(split, VALIDATION))
    threshold = recall_threshold(validation, "score", schema.target).first()["threshold"]
    return FrozenModel(pipeline, threshold, c_value, class_weight)


def fit_freeze_score(
    split: DataFrame, schema: ApplicationSchema, c_value: float | None = None, class_weight: str | None = None
) -> tuple[FrozenModel, DataFrame]:
    """The frozen model and the scored final rows; tunes C and weights when no C is given."""
    if c_value is None:
        _, c_value, class_weight = tune(part(split, DEVELOPMENT), schema)
    model = fit_freeze(split, schema, c_value, class_weight)
    return model, model.score(part(split, FINAL))


def calibration_report(split: DataFrame, schema: ApplicationSchema, model: FrozenModel) -> DataFrame:
    samples = {
        "validation": model.score(part(split, VALIDATION)),
        "final out-of-time test": model.score(part(split, FINAL)),
    }
    return calibration_summary(samples, "score", schema.target)


def challengers(
    split: DataFrame, schema: ApplicationSchema, c_value: float, class_weight: str | None = None,
    champion: FrozenModel | None = None,
) -> DataFrame:
    """The champion next to a score-only model and to the champion plus the withheld fields."""
    development, final = part(split, DEVELOPMENT), part(split, FINAL)
    single = fit_preparation(development, [schema.score], [], indicators=False)
    wider = [*schema.numeric, *schema.withheld]
    names = [
        ("Champion", len(schema.features)),
        (f"Challenger: {schema.score} alone", 1),
        (f"Sensitivity: champion plus {' and '.join(schema.withheld)}", len(wider) + len(schema.categorical)),
    ]
    fitted = run_together(
        split.sparkSession,
        [
            lambda: champion.pipeline if champion else fit_pipeline(development, schema, c_value, class_weight),
            lambda: fit_pipeline(development, schema, c_value, class_weight, preparation=single),
            lambda: fit_pipeline(development, schema, c_value, class_weight, numeric=wider),
        ],
    )
    points = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                F.lit(features).alias("features"),
                one.model.probability(one.preparation.columns()).alias("score"),
            )
            for (name, features), one in zip(names, fitted)
        ]
    )
    scored = final.select(schema.target, F.explode(points).alias("x")).select(schema.target, "x.*")
    found = binary_metrics(scored, "score", schema.target, None, ["model", "features"])
    return found.select("model", "features", "roc_auc", "pr_auc", "brier_score")


# The published columns, in their order.
RESULT_COLUMNS = (
    "model", "modeling_population_size", "evaluation_sample_size", "evaluation_defaults", "default_prevalence",
    "raw_feature_count", "feature_count", "split_method", "threshold_policy", "threshold", "roc_auc",
    "roc_auc_reported_binary", "pr_auc", "accuracy", "precision", "recall", "f1", "confusion_matrix", "true_negative",
    "false_positive", "false_negative", "true_positive", "brier_score", "roc_auc_ci_low", "roc_auc_ci_high",
    "pr_auc_ci_low", "pr_auc_ci_high", "brier_ci_low", "brier_ci_high", "test_rows_also_in_training", "notes",
)


def _confusion_text():
    cells = ("true_negative", "false_positive", "false_negative", "true_positive")
    return F.format_string("[[%d, %d], [%d, %d]]", *[F.col(c) for c in cells])


def corrected_row(
    split: DataFrame, schema: ApplicationSchema, model: FrozenModel, repetitions: int = 2000
) -> DataFrame:
    """One result row: metrics of the final rows with bootstrap intervals."""
    final = materialize(model.score(part(split, FINAL)).select(schema.row_id, schema.target, "score"))
    found = binary_metrics(final, "score", schema.target, model.threshold)
    ends = {
        r["metric"]: (r["ci_low"], r["ci_high"])
        for r in bootstrap_tree(final, "score", schema.target, repetitions).collect()
    }
    bounds = {}
    for short, metric in (("roc_auc", "roc_auc"), ("pr_auc", "pr_auc"), ("brier", "brier_score")):
        bounds[f"{short}_ci_low"], bounds[f"{short}_ci_high"] = ends[metric]
    dates = split.groupBy("split").agg(F.min(schema.date).alias("d")).collect()
    first = {r["split"]: r["d"] for r in dates}
    return _result_row(
        found,
        model="sound design",
        modeling_population_size=split.count(),
        raw_feature_count=len(schema.features),
        feature_count=len(model.pipeline.preparation.names),
        split_method=f"by time, cut at {first[VALIDATION]} and {first[FINAL]}",
        threshold_policy="largest that finds every validation positive",
        threshold=model.threshold,
        roc_auc_reported_binary=None,
        test_rows_also_in_training=0,
        notes=f"{repetitions} bootstrap repetitions, C {model.c_value}, class weight {model.class_weight}",
        **bounds,
    )


def _result_row(found: DataFrame, **values) -> DataFrame:
    kinds = {str: "string", int: "bigint"}
    made = found.withColumnsRenamed(
        {"rows": "evaluation_sample_size", "positives": "evaluation_defaults", "positive_rate": "default_prevalence"}
    )
    for name, value in values.items():
        made = made.withColumn(name, F.lit(value).cast(kinds.get(type(value), "double")))
    return made.withColumn("confusion_matrix", _confusion_text()).select(*RESULT_COLUMNS)


def faulty_row(found: DataFrame, population: int, features: int, threshold: float, reported: float, contaminated: int) -> DataFrame:
    """One result row for the faulty design, without intervals."""
    none = dict.fromkeys(
        ("roc_auc_ci_low", "roc_auc_ci_high", "pr_auc_ci_low", "pr_auc_ci_high", "brier_ci_low", "brier_ci_high")
    )
    return _result_row(
        found,
        model="faulty design",
        modeling_population_size=population,
        raw_feature_count=features,
        feature_count=features,
        split_method="exact random share of the oversampled rows",
        threshold_policy="best accuracy on the test rows",
        threshold=threshold,
        roc_auc_reported_binary=reported,
        test_rows_also_in_training=contaminated,
        notes=f"{contaminated} test rows have a copy in training",
        **none,
    )


