"""The whole study on a small loan book with all 35 fields, from CSV to report."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from loanproof.operators import audit, models, population
from loanproof.plans import attribution, validation
from loanproof.schema import LOAN_BOOK
from loanproof.session import materialize, shared_dir
from loanproof.sources import sinks
from loanproof.sources.applications import scan_applications


def loan(i: int, rng: random.Random) -> dict:
    risk = rng.random()
    late = i >= 520
    bad = int(rng.random() < 0.04 + 0.5 * risk**4)
    row = {f.name: None for f in LOAN_BOOK.fields}
    row.update(
        customer_id=f"CUST-{100000 + i}",
        application_date=dt.date(2022, 1, 1) + dt.timedelta(days=2 * i),
        age=19 + i % 60,
        state=["CA", "NY", "TX"][i % 3],
        zip_prefix=str(900 + i % 20),
        annual_income_at_application=None if i % 31 == 0 else 30000.0 + 1000 * rng.random(),
        current_income=40000.0 * rng.random(),
        employment_years=None if i % 20 == 0 else float(i % 30),
        credit_score=None if i % 37 == 0 else 800 - 250 * risk,
        debt_to_income=0.1 + 0.4 * rng.random(),
        loan_amount=5000.0 + 10 * i,
        interest_rate=0.05 + 0.1 * risk,
        term_months=[36, 60][i % 2],
        home_ownership=["OWN", "RENT", "MORTGAGE"][i % 3],
        purpose=["car", "home", "debt"][i % 3],
        channel=["web", "branch", "mobile", "partner"][i % 4],
        num_open_accounts=1 + i % 16,
        delinq_2y=i % 4,
        inq_6m=i % 6,
        credit_utilization=None if i % 41 == 0 else rng.random(),
        prior_defaults=0,
        bankruptcy_flag=int(i % 50 == 0),
        unemployment_rate=4.0 + rng.random(),
        prime_rate=5.0,
        manual_review_flag=i % 2,
        underwriter_score=rng.random(),
        model_version=f"v{i // 300}",
        months_observed=45 - i / 18,
        label_available=int(not late),
        days_past_due_6m_after=90 * bad,
        collections_contacted_9m_after=bad,
        charged_off_amount_12m=1000.0 * bad,
        account_status_12m="late" if bad else "current",
        current_balance=4000.0,
        default_12m=None if late else bad,
    )
    return row


@pytest.fixture(scope="module")
def book(spark):
    rng = random.Random(1)
    rows = [loan(i, rng) for i in range(600)]
    rows += [{**rows[i], "customer_id": f"CUST-{900000 + i}"} for i in range(0, 600, 60)]
    path = f"{shared_dir(spark)}/book-{uuid.uuid4().hex}"
    spark.createDataFrame([[r[n] for n in LOAN_BOOK.names] for r in rows], LOAN_BOOK.struct()).write.option(
        "header", True
    ).csv(path)
    return materialize(scan_applications(spark, path, LOAN_BOOK))


def test_population_and_audit(spark, book):
    assert book.count() == 610
    found = {(r["population"], r["audit_item"]): r["result"] for r in audit.audit_table(book, LOAN_BOOK).collect()}
    assert found["raw", "duplicate_rows"] == 20 and found["raw", "duplicate_groups"] == 10
    assert found["raw", "missing_targets"] == book.filter("default_12m is null").count()
    assert found["eligible", "rows"] == 520
    assert sum(found[p, "rows"] for p in ("development", "validation", "final_test")) == 520
    dictionary = {r["field"]: r for r in audit.field_dictionary(book, LOAN_BOOK).collect()}
    assert len(dictionary) == 35
    assert dictionary["credit_score"]["missing"] == book.filter("credit_score is null").count()
    assert dictionary["customer_id"]["distinct_values"] == 610
    path = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    sinks.write_reports({"dictionary": audit.field_dictionary(book, LOAN_BOOK), "sizes": book.groupBy().count()}, path)
    read = sinks.read_reports(spark, path)
    assert set(read) == {"dictionary", "sizes"} and read["dictionary"].count() == 35
    # A run that fails leaves the one before in force.
    broken = book.select(F.raise_error(F.lit("stop")).cast("string").alias("x"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_reports({"dictionary": book.limit(1), "broken": broken}, path)
    assert sinks.read_reports(spark, path)["dictionary"].count() == 35


def test_sound_design(book):
    split = validation.split_population(book, LOAN_BOOK)
    assert population.partition_overlap(split, "customer_id").first()["shared_customers"] == 0
    model, scored = validation.fit_freeze_score(split, LOAN_BOOK, 1.0)
    # 13 numeric, 3 flags for columns with gaps and 3 + 3 + 4 levels
    assert len(model.pipeline.preparation.names) == 26
    checked = model.score(validation.part(split, population.VALIDATION))
    assert checked.filter("default_12m = 1 and predicted = 0").count() == 0
    assert scored.filter(F.col("score").isNull()).count() == 0
    report = validation.calibration_report(split, LOAN_BOOK, model).collect()
    assert [r["sample"] for r in report] == ["validation", "final out-of-time test"]
    row = validation.corrected_row(split, LOAN_BOOK, model, repetitions=20).first()
    assert row["roc_auc_ci_low"] <= row["roc_auc"] <= row["roc_auc_ci_high"]
    assert row["feature_count"] == 26 and row["modeling_population_size"] == 520


def test_grid_search_selects_one_point(book):
    split = validation.split_population(book, LOAN_BOOK)
    table, c_value, weight = models.tune(validation.part(split, population.DEVELOPMENT), LOAN_BOOK)
    rows = table.collect()
    assert len(rows) == 8 and sum(r["selected"] for r in rows) == 1
    best = max(r["mean_pr_auc"] for r in rows)
    near = [r for r in rows if r["mean_pr_auc"] >= best - 0.01]
    chosen = min(near, key=lambda r: (r["mean_brier_score"], r["C"]))
    assert chosen["selected"] and chosen["C"] == c_value
    assert chosen["class_weight"] == (weight or "None")
    for r in rows:
        assert [d["train_rows"] for d in r["fold_detail"]] == [78, 156, 234]


def test_faulty_design_is_contaminated(book):
    budget = attribution.TreeBudget(3, 3, 3, 3, 3)
    found = attribution.faulty_pipeline_replay(book, LOAN_BOOK, 7, budget)
    dirty = found["contamination"].first()
    assert dirty["contaminated_rows"] > 0 and dirty["contaminated_positives"] > 0
    assert len(found["features"]) == 35
    assert found["metrics"].first()["roc_auc"] > 0.9


def test_dropped_fields(book):
    frame, numeric, categorical = attribution.attribution_frame(book, LOAN_BOOK, True, True)
    assert not set(LOAN_BOOK.leaked) & set(frame.columns)
    assert {"balance_to_loan", "income_change"}.isdisjoint(frame.columns)
    assert {"loan_to_income", "customer_number", "application_dayofweek"} <= set(numeric)
    assert {"state", "zip_prefix", "model_version"} <= set(categorical)
    assert frame.count() == book.filter("default_12m is not null").count()
