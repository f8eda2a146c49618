"""Contracts of readers, duplicates and sinks on literal frames."""

from __future__ import annotations

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from loanproof import queries
from loanproof.operators import audit, population
from loanproof.schema import APPS, LOAN_BOOK
from loanproof.session import shared_dir
from loanproof.sources import applications as src
from loanproof.sources import digests, sinks


def test_known_sizes(apps):
    scored = src.scored_applications(apps)
    assert (apps.count(), scored.count()) == (1533, 1363)
    assert scored.filter("default_12m = 1").count() == 149


def test_loan_book_fields():
    assert len(LOAN_BOOK.fields) == 35 and len(LOAN_BOOK.features) == 16
    roles = [LOAN_BOOK.role(n) for n in LOAN_BOOK.names]
    assert (roles.count("Predictor"), roles.count("Excluded")) == (16, 13)
    assert set(LOAN_BOOK.leaked) <= set(LOAN_BOOK.names)


def test_schema_is_enforced(spark, apps):
    with pytest.raises(src.SchemaMismatch, match="missing=\\['age'\\] extra=\\['years'\\]"):
        src.check_schema(apps.withColumnRenamed("age", "years"), APPS)
    with pytest.raises(src.SchemaMismatch, match="age: string"):
        src.check_schema(apps.withColumn("age", F.col("age").cast("string")), APPS)


def test_a_broken_cell_fails_the_read(spark, apps):
    path = f"{shared_dir(spark)}/broken-{uuid.uuid4().hex}"
    texts = apps.limit(20).withColumn("application_date", F.lit("31/12/1999"))
    texts.write.option("header", True).csv(path)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|FAILFAST"):
        src.scan_applications(spark, path, APPS).collect()


def test_strict_dates(spark):
    good = spark.createDataFrame([("2024-02-29",), (None,)], "t string")
    assert good.select(src.parse_date_strict("t")).filter("1 = 1").count() == 2
    bad = spark.createDataFrame([("2024-02-30",)], "t string")
    with pytest.raises(Exception, match="not a date"):
        bad.select(src.parse_date_strict("t").alias("d")).collect()


def test_every_date_text_goes_through_the_strict_parser(spark, folder, apps):
    found = queries.parse_date_strict(spark, folder)
    wanted = apps.select("app_id", F.col("application_date").cast("string").alias("application_date"))
    assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0


def test_reports_build_the_application_table_once(spark, folder, monkeypatch):
    built = []
    real = src.build_applications
    monkeypatch.setattr(src, "build_applications", lambda *a: built.append(a) or real(*a))
    monkeypatch.setattr(queries, "REPORTS", ("population_summary", "threshold_sweep", "score_rows"))
    rows = {r["report"]: r["rows"] for r in queries.report_sink(spark, folder).collect()}
    assert rows == {"population_summary": 3, "threshold_sweep": 91, "score_rows": 1363}
    assert len(built) == 1 and not queries._written


def test_triples_and_missing_cells_in_signatures(spark):
    rows = [(3, "a", None), (1, "a", None), (2, "a", None), (4, "b", 1), (5, "b", 2)]
    df = spark.createDataFrame(rows, "id int, k string, v int")
    counts = population.duplicate_counts(df, ["k", "v"]).first()
    assert tuple(counts) == (3, 1, 2)
    assert tuple(population.duplicate_pairs(df, ["k", "v"]).first()) == (1, 1, 2)
    kept = population.dedup_keep_first(df, ["k", "v"], "id")
    assert sorted(r["id"] for r in kept.collect()) == [1, 4, 5]


def test_eligibility_conditions_bind_alone(spark):
    rows = [(1, 1, 12), (None, 1, 12), (1, 0, 12), (1, 1, 11), (0, 1, 30)]
    df = spark.createDataFrame(rows, "default_12m int, label_available int, months_observed int")
    assert population.eligible_filter(df, APPS).count() == 2


def test_fingerprint_ignores_row_order(spark, apps):
    a = src.table_fingerprint(apps).first()
    b = src.table_fingerprint(apps.orderBy(F.desc("loan_amount")).select(*reversed(apps.columns))).first()
    assert a == b
    c = src.table_fingerprint(apps.withColumn("age", F.when(F.col("app_id") == 50, 1).otherwise(F.col("age")))).first()
    assert a["rows"] == c["rows"] and a != c


def test_label_maturity_without_labels(spark):
    rows = [("2024-10-05", 0, None, 10.3), ("2024-11-05", 0, None, 10.1), ("2025-01-01", 0, None, 7.2)]
    df = spark.createDataFrame(rows, "d string, label_available int, default_12m int, months_observed double")
    df = df.withColumn("application_date", F.col("d").cast("date"))
    found = {r["quarter"]: r for r in audit.label_maturity_by_quarter(df, APPS).collect()}
    assert found["2024Q4"]["defaults"] == 0 and found["2024Q4"]["observed_default_rate"] is None
    assert found["2024Q4"]["median_months_observed"] == pytest.approx(10.2)


def test_scores_are_written_by_quarter(spark, apps):
    path = f"{shared_dir(spark)}/scores-{uuid.uuid4().hex}"
    scored = src.scored_applications(apps)
    sinks.write_scores(sinks.score_rows(scored, APPS, 0.1), path, "application_date")
    back = spark.read.parquet(path)
    assert back.count() == scored.count() and "quarter" in back.columns
    plan = back.filter("quarter = '1998Q1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quarter" in plan


def test_no_task_reads_a_whole_large_file(spark, tmp_path, monkeypatch):
    """Files beyond the bytes of a link, one with a space in its name, go through several tasks."""
    monkeypatch.setattr(digests, "LINK", 1000)
    texts = {"a.parquet": bytes(range(256)) * 13, "b c.parquet": b"x" * 1000, "e.parquet": b"y" * 2001}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
    rounds, kept = [], digests.materialize

    def seen(df):
        rounds.append(kept(df))
        return rounds[-1]

    monkeypatch.setattr(digests, "materialize", seen)
    found = {r["file"]: (r["bytes"], r["sha256"]) for r in src.file_fingerprint(spark, f"{tmp_path}/*.parquet").collect()}
    assert found == {n: (len(t), hashlib.sha256(t).hexdigest()) for n, t in texts.items()}
    read = [{r["path"]: r["at"] for r in x.collect()} for x in rounds]
    steps = [now[p] - before[p] for before, now in zip(read, read[1:]) for p in now]
    assert len(read) == 5 and max(steps) == 1000


def test_digest_states_go_on():
    state = digests.begun()
    for piece in (b"a" * 63, b"", b"b", b"c" * 130):
        state = digests.added(state, [piece])
    assert digests.ended(state) == hashlib.sha256(b"a" * 63 + b"b" + b"c" * 130).hexdigest()
