"""Profiles of the raw table: missing cells, ranges, rules, label maturity, dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.functions.columns import quarter_bucket
from loanproof.operators.ordering import date_at_quantiles, exact_quantiles, running_totals, weighted_quantile
from loanproof.operators.population import (
    SPLIT_AT,
    cardinality,
    chronological_split,
    dedup_keep_first,
    duplicate_counts,
    eligible_filter,
    full_row_duplicates,
    repeated_ids,
)
from loanproof.schema import ApplicationSchema
from loanproof.session import materialize, small_table


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing cells per column from one pass, one row per field."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counted.unpivot(["_rows"], df.columns, "field", "missing")
    return long.select(
        "field",
        F.col("_rows").alias("rows"),
        "missing",
        (F.col("missing") / F.nullif(F.col("_rows"), F.lit(0))).alias("missing_rate"),
    )


def missing_by_outcome(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Missing rate of each field among positives and among negatives."""
    rates = df.filter(F.col(target).isNotNull()).groupBy(target).agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]
    )
    return rates.unpivot([target], list(columns), "field", "missing_rate")


def rule_violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that break each rule; a missing operand breaks none."""
    counted = df.agg(*[F.count_if(F.expr(predicate)).alias(name) for name, predicate in rules.items()])
    return counted.unpivot([], list(rules), "field", "violations")


def label_conflicts(df: DataFrame, schema: ApplicationSchema, months: float = 12) -> DataFrame:
    """Rows marked as unlabelled although the observation time has passed."""
    late = (F.col(schema.label_flag) == 0) & (F.col(schema.months) >= months)
    return df.agg(F.count("*").alias("rows"), F.count_if(late).alias("label_conflicts"))


def label_maturity_by_quarter(deduplicated: DataFrame, schema: ApplicationSchema) -> DataFrame:
    """Per application quarter of the deduplicated table: labels, defaults and follow-up.

    The table is read once, into one cell per quarter and month count; the sums and the
    median both come from the cells.
    """
    target, months = F.col(schema.target), F.col(schema.months)
    cells = deduplicated.groupBy(quarter_bucket(schema.date).alias("quarter"), schema.months).agg(
        F.count("*").alias("n"),
        F.count(months).alias("n_months"),
        F.sum(schema.label_flag).alias("flags"),
        F.count(target).alias("labels"),
        F.coalesce(F.sum(target), F.lit(0)).alias("positives"),
    )
    placed = running_totals(cells, schema.months, {"cum": "n_months"}, ["quarter"])
    labels, positives = F.sum("labels"), F.sum("positives")
    return placed.groupBy("quarter").agg(
        F.sum("n").alias("rows"),
        (F.sum("flags") / F.sum("n")).alias("label_available_rate"),
        labels.alias("observed_labels"),
        positives.alias("defaults"),
        (positives / F.nullif(labels, F.lit(0))).alias("observed_default_rate"),
        weighted_quantile(schema.months, "cum", 0.5).alias("median_months_observed"),
    )


def default_rate_by_year(raw: DataFrame, schema: ApplicationSchema) -> DataFrame:
    """Default rate per application year on raw rows that carry a label."""
    seen = raw.filter(F.col(schema.target).isNotNull())
    return seen.groupBy(F.year(schema.date).alias("year")).agg(
        F.count("*").alias("rows"), F.avg(schema.target).alias("default_rate")
    )


def label_rate_for_year(raw: DataFrame, schema: ApplicationSchema, year: int) -> DataFrame:
    first, after = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    day = F.col(schema.date)
    return raw.filter((day >= first) & (day < after)).agg(
        F.count("*").alias("rows"), F.avg(schema.label_flag).alias("label_rate")
    )


def outlier_screen(raw: DataFrame, schema: ApplicationSchema) -> DataFrame:
    """Range, first and last percentile, missing cells and rule breaks per numeric field."""
    fields = list(schema.screened)
    wide = raw.agg(
        *[
            F.struct(
                F.count_if(F.col(c).isNull()).alias("missing"),
                F.min(c).cast("double").alias("minimum"),
                F.max(c).cast("double").alias("maximum"),
                (F.count_if(F.expr(schema.rules[c])) if c in schema.rules else F.lit(0).cast("bigint")).alias("rule_violations"),
            ).alias(c)
            for c in fields
        ]
    )
    ranges = wide.unpivot([], fields, "field", "x").select("field", "x.*")
    tails = (
        exact_quantiles(raw, fields, [0.01, 0.99])
        .groupBy("field")
        .agg(
            F.max(F.when(F.col("prob") == 0.01, F.col("value"))).alias("p1"),
            F.max(F.when(F.col("prob") == 0.99, F.col("value"))).alias("p99"),
        )
    )
    held = F.col("field").isin(*schema.rules)
    return ranges.join(tails, "field", "left").withColumn(
        "treatment",
        F.when(held, "withheld: breaks its rule").otherwise(
            "kept"
        ),
    )


def field_dictionary(df: DataFrame, schema: ApplicationSchema) -> DataFrame:
    """The declared dictionary joined with what the table holds: missing cells and levels."""
    declared = small_table(
        df.sparkSession,
        {"field": "string", "tags": "string", "used_in_corrected_model": "boolean",
         "corrected_model_role": "string", "rationale": "string"},
        [
            (f.name, "; ".join(f.tags), f.name in schema.features, schema.role(f.name), f.rationale)
            for f in schema.fields
        ],
    )
    declared = declared.withColumn("classification", F.split("tags", "; ")).drop("tags")
    profile = missing_profile(df).drop("missing_rate")
    levels = cardinality(df, df.columns)
    return declared.join(profile, "field", "left").join(levels, "field", "left")


def audit_table(
    raw: DataFrame,
    schema: ApplicationSchema,
    years: Sequence[int] = (2022, 2024),
    label_year: int = 2025,
    contamination: DataFrame | None = None,
) -> DataFrame:
    """The audit: one row per item, every value computed from the named population.

    ``contamination`` is the one-row result of ``train_test_contamination`` on a design
    under study.
    """
    target = F.col(schema.target)
    day = F.col(schema.date)
    blank = F.col("credit_utilization").isNull()
    # One pass of deduplication: all eligible figures and the split come from sums per day.
    eligible = eligible_filter(dedup_keep_first(raw, schema.signature, schema.row_id), schema)
    days = materialize(
        eligible.groupBy(schema.date).agg(
            F.count("*").alias("n"),
            F.sum(target).alias("p"),
            F.count_if((target == 1) & blank).alias("blank_p"),
            F.count_if((target == 0) & blank).alias("blank_n"),
        )
    )
    split = chronological_split(days, schema, date_at_quantiles(days, schema.date, SPLIT_AT, "n"))

    def long(df: DataFrame, population: str, prefix: str = "") -> DataFrame:
        cols = [F.col(c).cast("double").alias(prefix + c) for c in df.columns]
        wide = df.select(*cols)
        return wide.unpivot([], wide.columns, "audit_item", "result").withColumn("population", F.lit(population))

    late = (F.col(schema.label_flag) == 0) & (F.col(schema.months) >= 12)
    raw_sums = raw.agg(
        F.count("*").alias("rows"),
        F.count(target).alias("observed_targets"),
        F.count_if(target.isNull()).alias("missing_targets"),
        F.count_if(late).alias("unavailable_labels_at_12_months"),
        F.count_if(F.expr(schema.rules["employment_years"])).alias("implausible_employment_tenure"),
        F.count_if(F.col(schema.income).isNull()).alias("missing_income"),
        F.count_if(F.col(schema.score).isNull()).alias("missing_credit_score"),
        F.count_if(F.col("credit_utilization").isNull()).alias("missing_utilization"),
        F.min(schema.income).alias("income_minimum"),
        F.max(schema.income).alias("income_maximum"),
        F.min(schema.score).alias("credit_score_minimum"),
        F.max(schema.score).alias("credit_score_maximum"),
        *[F.avg(F.when(F.year(day) == y, target)).alias(f"observed_default_rate_{y}") for y in years],
        F.avg(F.when(F.year(day) == label_year, F.col(schema.label_flag))).alias(
            f"label_availability_{label_year}"
        ),
    )
    rows, positives = F.sum("n"), F.sum("p")
    eligible_sums = days.agg(
        rows.alias("rows"),
        positives.alias("positives"),
        (positives / rows).alias("prevalence"),
        (F.sum("blank_p") / F.nullif(positives, F.lit(0))).alias("missing_utilization_rate_among_defaults"),
        (F.sum("blank_n") / F.nullif(rows - positives, F.lit(0))).alias("missing_utilization_rate_among_non_defaults"),
    )
    distinct = cardinality(raw, ["state", schema.customer, schema.row_id]).select(
        F.concat(F.lit("distinct_"), F.col("field")).alias("audit_item"),
        F.col("distinct_values").cast("double").alias("result"),
        F.lit("raw").alias("population"),
    )
    parts = split.groupBy("split").agg(rows.cast("double").alias("rows"), positives.cast("double").alias("positives"))
    part_rows = parts.unpivot(["split"], ["rows", "positives"], "audit_item", "result").select(
        "audit_item", "result", F.col("split").alias("population")
    )
    pieces = [
        long(raw_sums, "raw"),
        long(eligible_sums, "eligible"),
        long(duplicate_counts(raw, schema.signature), "raw"),
        long(full_row_duplicates(raw), "raw"),
        long(repeated_ids(raw, schema.row_id), "raw"),
        distinct,
        part_rows,
    ]
    if contamination is not None:
        pieces.append(long(contamination, "faulty test"))
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    return out
