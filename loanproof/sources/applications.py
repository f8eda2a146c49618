"""Readers, the schema contract and the application table built from order tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanproof.schema import APPS, ApplicationSchema
from loanproof.session import small_table
from loanproof.sources.digests import file_digests


class SchemaMismatch(ValueError):
    """Raised when a table's columns or types are not the declared ones."""


def scan_applications(spark: SparkSession, path: str, schema: ApplicationSchema) -> DataFrame:
    """Read an application table: parquet when the path says so, else CSV with header.

    The declared types are used, never inferred; a cell that does not parse fails the job.
    """
    if path.rstrip("/").endswith(".parquet"):
        return check_schema(spark.read.parquet(path), schema)
    header = spark.read.option("header", True).csv(path).columns
    check_names(header, schema)
    by_name = {f.name: f for f in schema.struct().fields}
    return (
        spark.read.schema(T.StructType([by_name[name] for name in header]))
        .options(header=True, mode="FAILFAST", dateFormat="yyyy-MM-dd", enforceSchema=False)
        .csv(path)
        .select(*schema.names)
    )


def check_names(columns: list[str], schema: ApplicationSchema) -> None:
    missing = sorted(set(schema.names) - set(columns))
    extra = sorted(set(columns) - set(schema.names))
    if missing or extra:
        raise SchemaMismatch(f"unexpected columns: missing={missing} extra={extra}")


def check_schema(df: DataFrame, schema: ApplicationSchema) -> DataFrame:
    """Pass the table through if names and types are the declared ones, else raise."""
    check_names(df.columns, schema)
    want = {f.name: f.dataType for f in schema.struct().fields}
    wrong = sorted(
        f"{f.name}: {f.dataType.simpleString()} instead of {want[f.name].simpleString()}"
        for f in df.schema.fields
        if f.dataType != want[f.name]
    )
    if wrong:
        raise SchemaMismatch(f"unexpected types: {wrong}")
    return df.select(*schema.names)


def schema_contract(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """One row per expected or found column: present, and cells that do not fit the type.

    All cells are tested in one aggregate, so the table is read once.
    """
    found = set(df.columns)
    checks = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(c)
        for c, kind in expected.items()
        if c in found
    ]
    counted = df.agg(*checks)
    listed = [(c, k, c in found, False) for c, k in expected.items()]
    listed += [(c, None, True, True) for c in df.columns if c not in expected]
    columns = small_table(
        df.sparkSession,
        {"field": "string", "expected_type": "string", "present": "boolean", "extra": "boolean"},
        listed,
    )
    bad = counted.unpivot([], counted.columns, "field", "bad_cells")
    return columns.join(F.broadcast(bad), "field", "left").select(
        "field",
        "expected_type",
        F.col("present").cast("int").alias("present"),
        F.col("extra").cast("int").alias("extra"),
        F.coalesce("bad_cells", F.lit(0)).alias("bad_cells"),
    )


def parse_date_strict(text: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """String to date; a text that is no date raises, missing stays missing."""
    col = F.col(text) if isinstance(text, str) else text
    parsed = F.try_to_date(col, fmt)
    return F.when(col.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("not a date: "), col)).cast("date")
    )


def date_parse_report(df: DataFrame, text: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """How many texts parse, per leading year text, without failing on the others."""
    parsed = F.try_to_date(F.col(text), fmt)
    return df.groupBy(F.year(parsed).alias("year")).agg(
        F.count("*").alias("rows"),
        F.count(parsed).alias("parsed"),
        F.count_if(F.col(text).isNotNull() & parsed.isNull()).alias("rejected"),
        F.count_if(F.col(text).isNull()).alias("missing"),
    )


def tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]


def build_applications(spark: SparkSession, folder: str) -> DataFrame:
    """The application table: one row per order, plus copies under new ids.

    Every 50th order appears once more and every 500th a third time. The copies come
    from one ``explode``, so the joins run once. Line items are summed per order before
    the join; the customer side joins by whatever way the planner finds by size.
    """
    orders, customer, lineitem = tables(spark, folder, "orders", "customer", "lineitem")
    money = F.col("l_extendedprice")
    lines = lineitem.groupBy("l_orderkey").agg(
        F.round(F.sum(money), 2).alias("gross"),
        F.round(F.sum(F.when(F.col("l_returnflag") == "R", money).otherwise(0.0)), 2).alias("returned"),
        F.count("*").alias("n_lines"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.sum("l_quantity").alias("qty"),
    )
    months = (2001 - F.year("o_orderdate")) * 12 + 12 - F.month("o_orderdate")
    matured = F.col("l_orderkey").isNotNull() & (
        F.col("o_orderdate") < F.lit("2000-12-01 00:00:00").cast("timestamp_ntz")
    )
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .withColumn("months", months)
        .withColumn("matured", matured)
    )
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    base = joined.select(
        key.alias("app_id"),
        cust.alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("application_date"),
        (18 + cust % 61).cast("int").alias("age"),
        F.col("c_nationkey").alias("state"),
        F.when(key % 31 != 0, F.col("c_acctbal")).alias("income"),
        F.when(key % 20 != 1, (cust * 7 % 450) / 10.0).alias("employment_years"),
        F.when(key % 37 != 0, (500 + cust * 37 % 341).cast("double")).alias("credit_score"),
        F.col("o_totalprice").alias("loan_amount"),
        (0.04 + (key % 15) / 100.0).alias("interest_rate"),
        F.when(key % 3 == 0, 60).otherwise(36).alias("term_months"),
        F.col("o_orderstatus").alias("home_ownership"),
        F.col("o_orderpriority").alias("purpose"),
        F.col("c_mktsegment").alias("channel"),
        F.coalesce("n_lines", F.lit(0)).cast("int").alias("num_open_accounts"),
        F.col("avg_disc").alias("debt_to_income"),
        (F.col("qty") / (50.0 * F.col("n_lines"))).alias("credit_utilization"),
        F.col("returned").alias("returned_value_12m"),
        F.round(F.col("o_totalprice") - F.col("returned"), 2).alias("current_balance"),
        F.col("months").cast("int").alias("months_observed"),
        F.col("matured").cast("int").alias("label_available"),
        F.when(F.col("matured"), (F.col("returned") > 0.75 * F.col("gross")).cast("int")).alias("default_12m"),
    )
    more = (F.col("app_id") % 50 == 0).cast("int") + (F.col("app_id") % 500 == 0).cast("int")
    copies = base.withColumn("copy_no", F.explode(F.sequence(F.lit(0), more)))
    return copies.withColumn("app_id", F.col("app_id") + F.col("copy_no") * 10_000_000).select(*APPS.names)


def scored_applications(apps: DataFrame, schema: ApplicationSchema = APPS) -> DataFrame:
    """Labelled rows with the score of a fixed scorecard (has ties, needs no fitting)."""
    line = 1.5 + 0.35 * F.col("num_open_accounts") - 4.0 * F.col("debt_to_income")
    return apps.filter(F.col(schema.target).isNotNull()).withColumn(
        "score", F.round(1.0 / (1.0 + F.exp(line)), 6)
    )


def row_text(df: DataFrame) -> Column:
    """A text of each row that any engine can repeat, columns by name.

    Cells carry their length; a missing one is '-'. Doubles count in millionths, dates are ISO, timestamps
    microseconds, nested values JSON.
    """
    cells = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("double", "float"):
            infinite = F.isnan(c) | (F.abs(c) == float("inf"))
            text = F.when(infinite, c.cast("string")).otherwise(F.round(F.when(~infinite, c) * 1e6).cast("decimal(38,0)").cast("string"))
        elif kind == "timestamp":
            text = F.unix_micros(c).cast("string")
        elif kind in ("array", "struct", "map"):
            text = F.to_json(c)
        else:
            text = c.cast("string")
        cells.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    return F.concat(*cells)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """A fingerprint of a table's rows that does not depend on their order.

    Each row's text gives one SHA-256; 60 bits of it are summed as a decimal, so the sum has
    room for 10^20 rows and every task sends one row to the final step.
    """
    part = F.conv(F.substring("digest", 1, 15), 16, 10).cast("decimal(20,0)")
    other = F.conv(F.substring("digest", 16, 15), 16, 10).cast("decimal(20,0)")
    return df.select(F.sha2(row_text(df), 256).alias("digest")).agg(
        F.count("*").alias("rows"),
        F.sum(part).cast("string").alias("sum_high"),
        F.sum(other).cast("string").alias("sum_low"),
    )


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 per input file, for bit-exact identity of deliveries."""
    return file_digests(spark, path).select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("bytes"),
        "sha256",
    )


def stack_frames(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
