"""The faulty design replayed, and the study that repairs one fault at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.functions.columns import above_threshold, date_parts, relative_change, safe_ratio
from loanproof.operators.metrics import (
    best_threshold,
    binary_metrics,
    champion_select,
    hard_label_auc,
    seed_summary,
    threshold_sweep,
    top_features,
)
from loanproof.operators.models import CONCURRENT_FITS, boosted_trees, forest_model, run_together, unpenalized_intercept_logistics
from loanproof.operators.population import chronological_cut, train_test_contamination
from loanproof.operators.prep import (
    Preparation,
    mutual_information,
    train_only_encoding,
    whole_sample_preparation,
)
from loanproof.operators.sampling import oversample_then_split, oversample_training, random_split_exact
from loanproof.schema import ApplicationSchema
from loanproof.session import let_go, materialize, materialize_packed

KEEP_FEATURES = 35
DERIVED = ("balance_to_loan", "income_change")


@dataclass(frozen=True)
class TreeBudget:
    """Sizes of the tree models: first comparison, tuning, and the attribution study."""

    forest: int = 500
    tuned_forest: int = 700
    rounds: int = 250
    tuned_rounds: int = 350
    study_rounds: int = 250


def attribution_frame(
    raw: DataFrame, schema: ApplicationSchema, drop_leaked: bool, drop_censored: bool
) -> tuple[DataFrame, list[str], list[str]]:
    """The faulty feature build with its switches; also the numeric and categorical fields.

    Missing targets become 0 unless ``drop_censored`` removes those rows. The row id and the
    date stay as columns for splitting, but are no features.
    """
    rows = raw.filter(F.col(schema.target).isNotNull()) if drop_censored else raw
    built = rows.withColumn(schema.target, F.coalesce(schema.target, F.lit(0)))
    number = F.col(schema.customer)
    if dict(raw.dtypes)[schema.customer] == "string":
        number = F.regexp_extract(number, r"(\d+)$", 1)
    built = built.select(
        "*",
        number.cast("double").alias("customer_number"),
        *date_parts(schema.date),
        safe_ratio(schema.amount, schema.income).alias("loan_to_income"),
        safe_ratio(schema.balance, schema.amount).alias("balance_to_loan"),
        relative_change(schema.later_income, schema.income).alias("income_change"),
    )
    if drop_leaked:
        built = built.drop(*schema.leaked, *DERIVED)
    skip = {schema.row_id, schema.customer, schema.date, schema.target}
    numeric = [c for c, t in built.dtypes if t not in ("string", "date") and c not in skip]
    categorical = [c for c, t in built.dtypes if t == "string" and c not in skip]
    return built, numeric, categorical


def screen(train: DataFrame, features: Sequence[str], target: str, keep: int = KEEP_FEATURES) -> list[str]:
    """The features with the most mutual information, best first."""
    best = top_features(mutual_information(train, features, target), keep=keep)
    return [r["feature"] for r in best.orderBy("place").collect()]


def _prepared(frame: DataFrame, prep: Preparation, schema: ApplicationSchema, *more: str) -> DataFrame:
    return materialize(prep.transform(frame, [schema.row_id, schema.target, *more]))


def _train(rows: DataFrame) -> DataFrame:
    return rows.filter("part = 'train'")


def _test(rows: DataFrame) -> DataFrame:
    return rows.filter("part = 'test'")


def faulty_pipeline_replay(
    raw: DataFrame, schema: ApplicationSchema, seed: int = 7, budget: TreeBudget = TreeBudget()
) -> dict:
    """The faulty design from end to end: relabel, prepare on all rows, oversample, screen,
    split at random, pick the model and the threshold on the test rows.

    Gives the test metrics, contamination, model comparison, tuning, relevance and the
    choices made.
    """
    target = schema.target
    frame, numeric, categorical = attribution_frame(raw, schema, drop_leaked=False, drop_censored=False)
    prep = whole_sample_preparation(frame, numeric, categorical, target)
    rows = materialize_packed(oversample_then_split(_prepared(frame, prep, schema), schema, seed))
    relevance = materialize(mutual_information(rows, prep.names, target))
    features = [r["feature"] for r in top_features(relevance, keep=KEEP_FEATURES).orderBy("place").collect()]
    train = materialize_packed(_train(rows).select(target, *features))
    test = materialize_packed(_test(rows).select("source_row_id", target, *features))

    spark = raw.sparkSession
    families: list[tuple[str, Callable]] = [
        ("logistic", lambda: unpenalized_intercept_logistics(train, features, target, [1.0])[0]),
        ("random_forest", lambda: forest_model(train, features, target, budget.forest, seed=seed)),
        ("gradient_boosting", lambda: boosted_trees(train, features, target, budget.rounds, seed=seed)),
    ]
    compared = _compare(test, target, _fit_all(spark, families))
    champion = champion_select(compared, [], "place").first()["model"]
    choices: dict[str, list[tuple[str, Callable]]] = {
        "random_forest": [
            (str(d), lambda d=d: forest_model(train, features, target, budget.tuned_forest, d, seed))
            for d in (3, 5, 8, 12, None)
        ],
        "logistic": [
            (str(c), lambda c=c: unpenalized_intercept_logistics(train, features, target, [c])[0])
            for c in (0.01, 0.1, 1, 10, 100)
        ],
        "gradient_boosting": [
            (str(d), lambda d=d: boosted_trees(train, features, target, budget.tuned_rounds, depth=d, seed=seed))
            for d in (1, 2, 3, 4)
        ],
    }
    options = _fit_all(spark, choices[champion])
    tuned = _compare(test, target, options)
    # The first option with the best accuracy wins; the AUC plays no part here.
    chosen = tuned.withColumn("roc_auc_of_decisions", F.lit(0.0))
    parameter = champion_select(chosen, [], "place").first()["model"]
    scored = materialize(dict(options)[parameter].score(test).select("source_row_id", target, "score"))
    threshold = best_threshold(threshold_sweep(scored, "score", target)).first()["threshold"]
    return {
        "metrics": binary_metrics(scored, "score", target, threshold),
        "reported_auc": hard_label_auc(scored, "score", target, threshold),
        "contamination": train_test_contamination(
            rows.select("source_row_id", "part", target), "source_row_id", "part", target
        ),
        "comparison": compared,
        "tuning": tuned,
        "relevance": relevance,
        "champion": champion,
        "parameter": parameter,
        "threshold": threshold,
        "features": features,
    }


def _fit_all(spark, named: Sequence[tuple[str, Callable]]) -> list[tuple[str, object]]:
    fitted = run_together(spark, [fit for _, fit in named])
    return [(name, model) for (name, _), model in zip(named, fitted)]


def _compare(test: DataFrame, target: str, fitted: Sequence[tuple[str, object]]) -> DataFrame:
    """Accuracy and AUC of the decisions at 0.5 of each model, in input order."""
    parts = None
    for place, (name, model) in enumerate(fitted):
        scored = model.score(test.select(target, *[c for c in test.columns if c not in ("source_row_id", target)]))
        rows = scored.select(
            F.lit(place).alias("place"), F.lit(name).alias("model"), target, above_threshold("score", 0.5).alias("decision")
        )
        parts = rows if parts is None else parts.unionByName(rows)
    found = binary_metrics(parts, "decision", target, 0.5, ["place", "model"])
    return materialize(found.select("place", "model", "accuracy", F.col("roc_auc").alias("roc_auc_of_decisions")))


def _run(rows: DataFrame, features: Sequence[str], schema: ApplicationSchema, rounds: int) -> DataFrame:
    """One row: AUC, rows and positives of the test part under the study's fixed model, written, so that
    nothing else of the variant need stay on disk."""
    model = boosted_trees(_train(rows), features, schema.target, rounds)
    scored = materialize(model.score(_test(rows).select(schema.target, *features)).select(schema.target, "score"))
    found = binary_metrics(scored, "score", schema.target)
    found = materialize(found.select("roc_auc", F.col("rows").alias("test_rows"), F.col("positives").alias("test_positives")))
    del model, scored, rows
    let_go(found)
    return found


def _early(prepared: DataFrame, features: Sequence[str], schema: ApplicationSchema, seed: int):
    """Oversample and screen all rows, then split."""
    rows = materialize_packed(oversample_then_split(prepared, schema, seed))
    return rows, screen(rows, features, schema.target)


def _late(parted: DataFrame, features: Sequence[str], schema: ApplicationSchema, seed: int):
    """Oversample and screen the training rows of an existing split."""
    rows = materialize_packed(oversample_training(parted, schema, seed))
    return rows, screen(_train(rows), features, schema.target)


def _abreast(spark) -> int:
    """Variants at a time: a fit is mostly one task, so there is one for each core, up to eight."""
    return max(CONCURRENT_FITS, min(8, spark.sparkContext.defaultParallelism))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def leakage_2x2(
    raw: DataFrame, schema: ApplicationSchema, seeds: Sequence[int] = (7, 8, 9, 10, 11), rounds: int = 250
) -> DataFrame:
    """Leaked fields kept or removed x oversampling before or after the split, over seeds.

    The prepared table does not depend on the seed and is written once per field choice.
    """

    def prepared_rows(kept: bool):
        frame, numeric, categorical = attribution_frame(raw, schema, drop_leaked=not kept, drop_censored=False)
        prep = whole_sample_preparation(frame, numeric, categorical, schema.target)
        return _prepared(frame, prep, schema), prep.names

    def variant(prepared: DataFrame, names: Sequence[str], kept: bool, first: bool, seed: int) -> DataFrame:
        step = f"leaked fields {'kept' if kept else 'removed'}; oversampling {'before' if first else 'after'} the split"
        if first:
            rows, features = _early(prepared, names, schema, seed)
        else:
            rows, features = _late(random_split_exact(prepared, seed, schema.row_id), names, schema, seed)
        found = _run(rows, features, schema, rounds)
        return found.select(F.lit(step).alias("step"), F.col("roc_auc").alias("test_roc_auc"))

    spark = raw.sparkSession
    made = dict(zip((True, False), run_together(spark, [lambda k=k: prepared_rows(k) for k in (True, False)])))
    variants = [(k, first, seed) for k in (True, False) for first in (True, False) for seed in seeds]
    jobs = [lambda k=k, f=f, s=s: variant(*made[k], k, f, s) for k, f, s in variants]
    runs = run_together(spark, jobs, _abreast(spark))
    return seed_summary(_union(runs), ["step"], "test_roc_auc")


def repair_ladder(raw: DataFrame, schema: ApplicationSchema, seed: int = 7, rounds: int = 250) -> DataFrame:
    """One repair added at a time, with the model family held fixed. The rungs run together."""
    target = schema.target

    def whole(drop_leaked: bool):
        frame, numeric, categorical = attribution_frame(raw, schema, drop_leaked, False)
        prep = whole_sample_preparation(frame, numeric, categorical, target)
        return _prepared(frame, prep, schema), prep.names

    def as_submitted(drop_leaked: bool) -> DataFrame:
        prepared, names = whole(drop_leaked)
        rows, features = _early(prepared, names, schema, seed)
        return _run(rows, features, schema, rounds)

    def oversample_later() -> DataFrame:
        prepared, names = whole(True)
        rows, features = _late(random_split_exact(prepared, seed, schema.row_id), names, schema, seed)
        return _run(rows, features, schema, rounds)

    def train_only(drop_censored: bool, in_time: bool) -> DataFrame:
        frame, numeric, categorical = attribution_frame(raw, schema, True, drop_censored)
        frame = materialize(frame)
        parted = chronological_cut(frame, schema) if in_time else random_split_exact(frame, seed, schema.row_id)
        prep = train_only_encoding(_train(parted), parted, numeric, categorical, target)
        rows, features = _late(_prepared(parted, prep, schema, "part"), prep.names, schema, seed)
        return _run(rows, features, schema, rounds)

    rungs: list[tuple[str, Callable]] = [
        ("0 all faults", lambda: as_submitted(False)),
        ("1 no leaked fields", lambda: as_submitted(True)),
        ("2 copies after the split", oversample_later),
        ("3 statistics of training rows", lambda: train_only(False, False)),
        ("4 no censored rows", lambda: train_only(True, False)),
        ("5 split by time", lambda: train_only(True, True)),
    ]
    found = run_together(raw.sparkSession, [job for _, job in rungs], _abreast(raw.sparkSession))
    return _union([row.select(F.lit(label).alias("step"), "*") for (label, _), row in zip(rungs, found)])
