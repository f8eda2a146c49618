"""Who is in the study: duplicates, eligibility, time splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanproof.operators.ordering import at_or_after, date_at_quantiles, keys_at_positions
from loanproof.schema import ApplicationSchema

DEVELOPMENT, VALIDATION, FINAL = "development", "validation", "final_test"


def duplicate_groups(df: DataFrame, signature: Sequence[str]) -> DataFrame:
    """Signatures that occur more than once. NULL equals NULL, as grouping does."""
    return df.groupBy(*signature).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_counts(df: DataFrame, signature: Sequence[str]) -> DataFrame:
    """Rows in duplicate groups, number of groups and rows that removal would drop."""
    return duplicate_groups(df, signature).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
        F.count("*").alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_removed"),
    )


def duplicate_pairs(df: DataFrame, signature: Sequence[str]) -> DataFrame:
    """Half the duplicated rows, next to the figures that also hold for triples."""
    return duplicate_counts(df, signature).select(
        F.floor(F.col("duplicate_rows") / 2).alias("pairs"),
        F.col("duplicate_groups").alias("groups"),
        F.col("rows_removed").alias("extra_rows"),
    )


def dedup_keep_first(df: DataFrame, signature: Sequence[str], row_id: str) -> DataFrame:
    """One row per signature, the one with the smallest id.

    An aggregate, not a window: copies collapse before the shuffle, so a signature that
    holds a third of the table sends one row per task and never fills a task.
    """
    rest = [c for c in df.columns if c not in signature and c != row_id]
    kept = df.groupBy(*signature).agg(
        F.min(row_id).alias(row_id), *[F.min_by(c, row_id).alias(c) for c in rest]
    )
    return kept.select(*df.columns)


def full_row_duplicates(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("full_row_duplicates")
    )


def repeated_ids(df: DataFrame, key: str) -> DataFrame:
    seen = df.groupBy(key).agg(F.count("*").alias("n"))
    return seen.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_with_repeated_id"),
        F.count_if(F.col("n") > 1).alias("repeated_ids"),
    )


def cardinality(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct values per column; the approximate mode needs no shuffle of values."""
    if not exact:
        counted = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return counted.unpivot([], list(columns), "field", "distinct_values")
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    distinct = df.select(cells.alias("x")).select("x.*").distinct()
    return distinct.groupBy("field").agg(F.count("v").alias("distinct_values"))


def is_eligible(schema: ApplicationSchema, months: float = 12) -> Column:
    return (
        F.col(schema.target).isNotNull()
        & (F.col(schema.label_flag) == 1)
        & (F.col(schema.months) >= months)
    )


def eligible_filter(df: DataFrame, schema: ApplicationSchema) -> DataFrame:
    return df.filter(is_eligible(schema))


def eligible_population(df: DataFrame, schema: ApplicationSchema) -> DataFrame:
    """Deduplicated rows with a matured label.

    Deduplication comes first, because which copy survives must not depend on the label.
    """
    return eligible_filter(dedup_keep_first(df, schema.signature, schema.row_id), schema)


SPLIT_AT = (0.60, 0.80)


def split_dates(eligible: DataFrame, schema: ApplicationSchema, probs=SPLIT_AT) -> list:
    return date_at_quantiles(eligible, schema.date, probs)


def chronological_split(eligible: DataFrame, schema: ApplicationSchema, dates: Sequence | None = None) -> DataFrame:
    """Adds ``split``: development before the first date, validation up to the second, then final.

    All rows of one day fall on the same side.
    """
    first, second = dates or split_dates(eligible, schema)
    day = F.col(schema.date)
    return eligible.withColumn(
        "split",
        F.when(day < F.lit(first), DEVELOPMENT).when(day < F.lit(second), VALIDATION).otherwise(FINAL),
    )


def partition_summary(df: DataFrame, schema: ApplicationSchema, by: str = "split") -> DataFrame:
    return df.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(schema.target), F.lit(0)).cast("bigint").alias("positives"),
        F.min(schema.date).alias("first_date"),
        F.max(schema.date).alias("last_date"),
    )


def check_partitions(df: DataFrame, schema: ApplicationSchema, by: str = "split", customers: bool = True) -> None:
    """Raise when a partition lacks positives or, if asked, when two share a customer."""
    for row in partition_summary(df, schema, by).collect():
        if not row["positives"]:
            raise ValueError(f"partition {row[by]} has no positive row")
    if customers:
        shared = partition_overlap(df, schema.customer, by).first()["shared_customers"]
        if shared:
            raise ValueError(f"{shared} customers occur in more than one partition")


def partition_overlap(df: DataFrame, customer: str, by: str = "split") -> DataFrame:
    """Customers seen in more than one partition, from one aggregate.

    Three flags per customer are combined before the shuffle, so a customer with very many
    rows costs no more than any other.
    """
    flags = {DEVELOPMENT: "d", VALIDATION: "v", FINAL: "f"}
    seen = df.groupBy(customer).agg(
        *[F.max(F.col(by) == name).alias(short) for name, short in flags.items()]
    )
    d, v, f = (F.col(c) for c in flags.values())
    return seen.agg(
        F.count("*").alias("customers"),
        F.count_if(d & v).alias("development_validation"),
        F.count_if(d & f).alias("development_final_test"),
        F.count_if(v & f).alias("validation_final_test"),
        F.count_if((d & v) | (d & f) | (v & f)).alias("shared_customers"),
    )


def population_summary(raw: DataFrame, schema: ApplicationSchema) -> DataFrame:
    """Rows, positives and prevalence of the raw, deduplicated and eligible populations."""
    target = F.col(schema.target)
    ok = is_eligible(schema)
    sums = [
        F.count("*").alias("rows"),
        F.count(target).alias("labelled"),
        F.coalesce(F.sum(target), F.lit(0)).cast("bigint").alias("positives"),
        F.avg(target).alias("prevalence"),
    ]
    deduplicated = dedup_keep_first(raw, schema.signature, schema.row_id)
    names = F.array(F.lit("deduplicated"), F.when(ok, F.lit("eligible")))
    named = deduplicated.withColumn("population", F.explode(names)).filter(F.col("population").isNotNull())
    later = named.groupBy("population").agg(*sums)
    return raw.agg(*sums).withColumn("population", F.lit("raw")).unionByName(later)


def chronological_cut(df: DataFrame, schema: ApplicationSchema, share: float = 0.75) -> DataFrame:
    """Adds ``part``: train for the first int(share * n) rows in time order, test after."""
    order = [schema.date, schema.row_id]
    (key,) = keys_at_positions(df, schema.date, order, lambda n: [int(n * share)])
    test = F.lit(False) if key is None else at_or_after(order, key)
    return df.withColumn("part", F.when(test, "test").otherwise("train"))


def fold_block(df: DataFrame, schema: ApplicationSchema, folds: int = 3) -> DataFrame:
    """Adds ``block`` 0..folds for expanding-window validation in time order.

    Each test block has n // (folds + 1) rows. Fold f validates block f and trains on all
    blocks before it, so one column describes all folds.
    """
    order = [schema.date, schema.row_id]

    def starts_of(n: int) -> list[int]:
        size = n // (folds + 1)
        if size == 0:
            raise ValueError(f"{n} rows are too few for {folds} folds")
        return [n - (folds - f) * size for f in range(folds)]

    starts = keys_at_positions(df, schema.date, order, starts_of)
    block = F.lit(0)
    for key in starts:
        block = block + at_or_after(order, key).cast("int")
    return df.withColumn("block", block)


def time_series_folds(blocked: DataFrame, schema: ApplicationSchema, folds: int = 3) -> DataFrame:
    """Sizes and positives per fold, and whether a day sits on both sides of its start."""
    blocks = blocked.groupBy("block").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(schema.target), F.lit(0)).cast("bigint").alias("p"),
        F.min(schema.date).alias("first_day"),
        F.max(schema.date).alias("last_day"),
    )
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        F.col("block").alias("fold"),
        F.sum("n").over(earlier).alias("train_rows"),
        F.sum("p").over(earlier).alias("train_positives"),
        F.col("n").alias("validation_rows"),
        F.col("p").alias("validation_positives"),
        (F.max("last_day").over(earlier) == F.col("first_day")).cast("int").alias("shares_first_day"),
    ).filter("fold >= 1")


def train_test_contamination(rows: DataFrame, source: str, part: str, target: str) -> DataFrame:
    """Test rows whose source row is also in train.

    One aggregate per source row instead of a distinct and a semi join, so a source that
    was drawn very often is combined before the shuffle.
    """
    test = F.col(part) == "test"
    seen = rows.groupBy(source).agg(
        F.count_if(~test).alias("in_train"),
        F.count_if(test).alias("in_test"),
        F.count_if(test & (F.col(target) == 1)).alias("positives_in_test"),
    )
    shared = F.col("in_train") > 0
    return seen.agg(
        F.sum("in_test").alias("test_rows"),
        F.sum("positives_in_test").alias("test_positives"),
        F.coalesce(F.sum(F.when(shared, F.col("in_test"))), F.lit(0)).alias("contaminated_rows"),
        F.coalesce(F.sum(F.when(shared, F.col("positives_in_test"))), F.lit(0)).alias("contaminated_positives"),
        F.count_if(F.col("in_test") > 0).alias("unique_test_sources"),
    ).withColumn("contaminated_rate", F.col("contaminated_rows") / F.nullif(F.col("test_rows"), F.lit(0)))
