"""SQL texts that compute each registered query's result in another engine."""

from __future__ import annotations

from loanproof.schema import APPS

# The application table as SQL over the order tables.
_APPS = """
li AS (
  SELECT l_orderkey,
         ROUND(SUM(l_extendedprice), 2) AS gross,
         ROUND(SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0e0 END), 2) AS returned,
         COUNT(*) AS n_lines, ROUND(AVG(l_discount), 6) AS avg_disc, SUM(l_quantity) AS qty
  FROM lineitem GROUP BY l_orderkey
), j AS (
  SELECT o.*, c.c_acctbal, c.c_mktsegment, c.c_nationkey, li.*,
         (2001 - YEAR(o.o_orderdate)) * 12 + 12 - MONTH(o.o_orderdate) AS months_observed,
         CASE WHEN li.l_orderkey IS NOT NULL
               AND o.o_orderdate < TIMESTAMP '2000-12-01 00:00:00' THEN 1 ELSE 0 END AS label_available
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey
), base AS (
  SELECT o_orderkey AS app_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS application_date,
         CAST(18 + o_custkey % 61 AS INT) AS age, c_nationkey AS state,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE c_acctbal END AS income,
         CASE WHEN o_orderkey % 20 = 1 THEN NULL ELSE (o_custkey * 7 % 450) / 10e0 END AS employment_years,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(500 + o_custkey * 37 % 341 AS DOUBLE) END AS credit_score,
         o_totalprice AS loan_amount, 0.04e0 + (o_orderkey % 15) / 100e0 AS interest_rate,
         CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE 36 END AS term_months,
         o_orderstatus AS home_ownership, o_orderpriority AS purpose, c_mktsegment AS channel,
         CAST(COALESCE(n_lines, 0) AS INT) AS num_open_accounts, avg_disc AS debt_to_income,
         qty / (50e0 * n_lines) AS credit_utilization,
         returned AS returned_value_12m, ROUND(o_totalprice - returned, 2) AS current_balance,
         CAST(months_observed AS INT) AS months_observed, label_available,
         CASE WHEN label_available = 1
              THEN CASE WHEN returned > 0.75e0 * gross THEN 1 ELSE 0 END END AS default_12m
  FROM j
), apps AS MATERIALIZED (
  SELECT * FROM base
  UNION ALL SELECT app_id + 10000000 AS app_id, * EXCLUDE (app_id) FROM base WHERE app_id % 50 = 0
  UNION ALL SELECT app_id + 20000000 AS app_id, * EXCLUDE (app_id) FROM base WHERE app_id % 500 = 0
)"""

_SIG = ", ".join(APPS.signature)

_SCORED = """
scored AS MATERIALIZED (
  SELECT *, ROUND(1e0 / (1e0 + EXP(1.5e0 + 0.35e0 * num_open_accounts - 4e0 * debt_to_income)), 6) AS score
  FROM apps WHERE default_12m IS NOT NULL
)"""

_DEDUP = f"""
dedup AS MATERIALIZED (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {_SIG} ORDER BY app_id) AS rn FROM apps) WHERE rn = 1
)"""

_ELIGIBLE = """
eligible AS MATERIALIZED (
  SELECT * FROM dedup WHERE default_12m IS NOT NULL AND label_available = 1 AND months_observed >= 12
)"""

_SPLIT = """
spots AS (
  SELECT application_date AS d, ROW_NUMBER() OVER (ORDER BY application_date) - 1 AS k, COUNT(*) OVER () AS n
  FROM eligible
), cuts AS (
  SELECT MAX(CASE WHEN k = CEIL((n - 1) * 0.6e0) THEN d END) AS b1,
         MAX(CASE WHEN k = CEIL((n - 1) * 0.8e0) THEN d END) AS b2 FROM spots
), split AS MATERIALIZED (
  SELECT eligible.*, CASE WHEN application_date < b1 THEN 'development'
                          WHEN application_date < b2 THEN 'validation' ELSE 'final_test' END AS split
  FROM eligible, cuts
)"""

_PLACED = """
placed AS MATERIALIZED (
  SELECT *, ROW_NUMBER() OVER (ORDER BY application_date, app_id) - 1 AS ordinal, COUNT(*) OVER () AS n FROM eligible
), blocked AS MATERIALIZED (
  SELECT *, CASE WHEN ordinal >= n - n // 4 THEN 3 WHEN ordinal >= n - 2 * (n // 4) THEN 2
                 WHEN ordinal >= n - 3 * (n // 4) THEN 1 ELSE 0 END AS block FROM placed
)"""

_RANKED = """
cells AS (
  SELECT score, SUM(default_12m) AS pos, SUM(1 - default_12m) AS neg FROM scored GROUP BY score
), ranked AS (
  SELECT *, SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
         SUM(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
         SUM(pos) OVER () AS p, SUM(neg) OVER () AS n
  FROM cells
)"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([_APPS, *ctes]) + "\n" + body.strip()


def _apps(body: str) -> str:
    return _with(body)


def _scored(body: str) -> str:
    return _with(body, _SCORED)


def _dedup(body: str) -> str:
    return _with(body, _DEDUP)


def _eligible(body: str) -> str:
    return _with(body, _DEDUP, _ELIGIBLE)


def _split(body: str) -> str:
    return _with(body, _DEDUP, _ELIGIBLE, _SPLIT)


def _blocked(body: str) -> str:
    return _with(body, _DEDUP, _ELIGIBLE, _PLACED)


def _ranked(body: str) -> str:
    return _with(body, _SCORED, _RANKED)


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _dictionary_rows() -> str:
    def quote(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    return ", ".join(
        f"({quote(f.name)}, {quote('; '.join(f.tags))}, {int(f.name in APPS.features)}, "
        f"{quote(APPS.role(f.name))}, {quote(f.rationale)})"
        for f in APPS.fields
    )


_MATURITY = """
SELECT CAST(YEAR(application_date) AS VARCHAR) || 'Q' || CAST(QUARTER(application_date) AS VARCHAR) AS quarter,
       COUNT(*) AS rows, ROUND(AVG(label_available), 6) AS label_available_rate,
       COUNT(default_12m) AS observed_labels, CAST(COALESCE(SUM(default_12m), 0) AS BIGINT) AS defaults,
       ROUND(AVG(default_12m), 6) AS observed_default_rate,
       ROUND(QUANTILE_CONT(CAST(months_observed AS DOUBLE), 0.5), 6) AS median_months_observed
FROM dedup GROUP BY 1"""

# Metrics of cells ranked within the groups named in {g}; {cells} gives g, score, pos, neg.
_GROUP_METRICS = """
ranked AS (
  SELECT *, SUM(pos) OVER (PARTITION BY {g} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
         SUM(neg) OVER (PARTITION BY {g} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp
  FROM cells
), metrics AS (
  SELECT {g}, CAST(SUM(pos + neg) AS BIGINT) AS rows, CAST(SUM(pos) AS BIGINT) AS positives,
         SUM(pos) / SUM(pos + neg) AS positive_rate, SUM(score * (pos + neg)) / SUM(pos + neg) AS mean_score,
         SUM(neg * (tp - pos / 2e0)) / NULLIF(CAST(SUM(pos) AS DOUBLE) * SUM(neg), 0) AS roc_auc,
         SUM(pos * tp / (tp + fp)) / NULLIF(SUM(pos), 0) AS pr_auc,
         SUM(pos * (1 - score) * (1 - score) + neg * score * score) / SUM(pos + neg) AS brier_score,
         CAST(SUM(CASE WHEN score >= {t} THEN 0 ELSE neg END) AS BIGINT) AS tn,
         CAST(SUM(CASE WHEN score >= {t} THEN neg ELSE 0 END) AS BIGINT) AS fpos,
         CAST(SUM(CASE WHEN score >= {t} THEN 0 ELSE pos END) AS BIGINT) AS fn,
         CAST(SUM(CASE WHEN score >= {t} THEN pos ELSE 0 END) AS BIGINT) AS tpos
  FROM ranked GROUP BY {g}
)"""

_METRIC_LIST = """rows, positives, ROUND(positive_rate, 6) AS positive_rate, ROUND(mean_score, 6) AS mean_score,
       ROUND(roc_auc, 6) AS roc_auc, ROUND(pr_auc, 6) AS pr_auc, ROUND(brier_score, 6) AS brier_score,
       ROUND((tpos + tn) / rows, 6) AS accuracy,
       ROUND(CASE WHEN tpos + fpos = 0 THEN 0 ELSE tpos / (tpos + fpos) END, 6) AS precision,
       ROUND(CASE WHEN tpos + fn = 0 THEN 0 ELSE tpos / (tpos + fn) END, 6) AS recall,
       ROUND(CASE WHEN 2 * tpos + fpos + fn = 0 THEN 0 ELSE 2 * tpos / (2 * tpos + fpos + fn) END, 6) AS f1,
       ROUND(fpos / NULLIF(fpos + tn, 0), 6) AS false_positive_rate,
       ROUND((tpos + fpos) / rows, 6) AS flag_rate,
       tn AS true_negative, fpos AS false_positive, fn AS false_negative, tpos AS true_positive"""

_PAIRS = [
    ("home_ownership", "home_ownership"), ("channel", "channel"), ("state", "CAST(state AS VARCHAR)"),
]


def _fingerprint() -> str:
    cells = []
    for f in sorted(APPS.struct().fields, key=lambda f: f.name):
        text = f"CAST({f.name} AS VARCHAR)"
        if f.dataType.typeName() == "double":
            text = f"CAST(CAST(ROUND({f.name} * 1e6) AS DECIMAL(38,0)) AS VARCHAR)"
        cells.append(f"COALESCE(LENGTH({text}) || ':' || {text}, '-')")
    part = "CAST(SUM(CAST('0x' || SUBSTR(h, {}, 15) AS BIGINT)) AS VARCHAR)"
    return f"""
, hashed AS (SELECT SHA256({" || ".join(cells)}) AS h FROM apps)
SELECT COUNT(*) AS rows, {part.format(1)} AS sum_high, {part.format(16)} AS sum_low FROM hashed"""


def _sources() -> dict[str, str]:
    shown = {"application_date": "CAST(application_date AS VARCHAR)", "default_12m": "CAST(default_12m AS DOUBLE)",
             **{c: f"ROUND({c}, 6)" for c in ("interest_rate", "credit_utilization", "income", "loan_amount")}}
    cols = ", ".join(f"{shown[c]} AS {c}" if c in shown else c for c in APPS.names)
    sql_names = {"bigint": "BIGINT", "date": "DATE", "int": "INT", "double": "DOUBLE", "string": "VARCHAR"}
    kinds = {f.name: f.dataType.simpleString() for f in APPS.struct().fields if f.name != "channel"}
    kinds |= {"home_ownership": "int", "purpose": "date"}  # on purpose: cells that do not fit
    contract = [
        f"SELECT '{c}' AS field, '{t}' AS expected_type, 1 AS present, 0 AS extra, "
        f"COUNT(CASE WHEN {c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {sql_names[t]}) IS NULL THEN 1 END) AS bad_cells FROM apps"
        for c, t in kinds.items()
    ]
    contract.append("SELECT 'zip_prefix', 'string', 0, 0, 0")
    contract.append("SELECT 'channel', NULL, 1, 1, 0")
    profile = _union(
        f"SELECT '{c}' AS field, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS missing, "
        f"COUNT(DISTINCT {c}) AS distinct_values FROM apps" for c in APPS.names
    )
    return {
        "scan_applications": _apps(f"SELECT {cols} FROM apps"),
        "parse_date_strict": _apps("SELECT app_id, CAST(application_date AS VARCHAR) AS application_date FROM apps"),
        "date_parse_report": _apps("""
, texts AS (SELECT CASE WHEN app_id % 97 = 0 THEN STRFTIME(application_date, '%d/%m/%Y')
                 WHEN app_id % 101 = 0 THEN NULL
                 ELSE CAST(application_date AS VARCHAR) END AS t FROM apps)
SELECT CAST(YEAR(TRY_STRPTIME(t, '%Y-%m-%d')) AS DOUBLE) AS year, COUNT(*) AS rows,
       COUNT(TRY_STRPTIME(t, '%Y-%m-%d')) AS parsed,
       COUNT(CASE WHEN t IS NOT NULL AND TRY_STRPTIME(t, '%Y-%m-%d') IS NULL THEN 1 END) AS rejected,
       COUNT(CASE WHEN t IS NULL THEN 1 END) AS missing
FROM texts GROUP BY 1"""),
        "schema_contract": _apps("SELECT * FROM (" + _union(contract) + ")"),
        "field_dictionary": _apps(f"""
, declared(field, classification, used_in_corrected_model, corrected_model_role, rationale) AS (
  VALUES {_dictionary_rows()}), profile AS ({profile})
SELECT declared.*, rows, missing, distinct_values FROM declared JOIN profile USING (field)"""),
        "table_fingerprint": _apps(_fingerprint()),
        "score_sink": _scored("""
SELECT app_id, CAST(application_date AS VARCHAR) AS application_date, age, state, default_12m,
       score AS probability_default, 0.1e0 AS threshold, CAST(score >= 0.1e0 AS INT) AS predicted_default,
       CAST(YEAR(application_date) AS VARCHAR) || 'Q' || CAST(QUARTER(application_date) AS VARCHAR) AS quarter
FROM scored"""),
    }


def _projections() -> dict[str, str]:
    return {
        "censored_as_negative": _apps("SELECT app_id, COALESCE(default_12m, 0) AS default_12m FROM apps"),
        "id_to_number": """SELECT c_name, CAST(REPLACE(c_name, 'Customer#', '') AS BIGINT) AS customer_number FROM customer""",
        "date_parts": _apps("""
SELECT app_id, CAST(YEAR(application_date) AS INT) AS application_year, CAST(MONTH(application_date) AS INT) AS application_month,
       CAST(DAY(application_date) AS INT) AS application_day, CAST((DAYOFWEEK(application_date) + 6) % 7 AS INT) AS application_dayofweek
FROM apps"""),
        "safe_ratios": _apps("""
SELECT app_id, ROUND(loan_amount / NULLIF(income, 0), 6) AS loan_to_income,
       ROUND(current_balance / NULLIF(loan_amount, 0), 6) AS balance_to_loan,
       ROUND((returned_value_12m - income) / NULLIF(income, 0), 6) AS income_change FROM apps"""),
        "eligible_filter": _dedup("""
SELECT app_id, default_12m, months_observed FROM dedup
WHERE default_12m IS NOT NULL AND label_available = 1 AND months_observed >= 12"""),
        "drop_censored": _apps("SELECT app_id, default_12m FROM apps WHERE default_12m IS NOT NULL"),
        "drop_leaked_fields": _apps("""
SELECT app_id, customer_id, age, state, income, employment_years, credit_score, loan_amount, ROUND(interest_rate, 6) AS interest_rate, term_months,
       home_ownership, purpose, channel, num_open_accounts, debt_to_income, ROUND(credit_utilization, 6) AS credit_utilization,
       CAST(default_12m AS DOUBLE) AS default_12m,
       ROUND(loan_amount / NULLIF(income, 0), 6) AS loan_to_income FROM apps"""),
        "inf_null_fill": _apps("""
, x AS (SELECT app_id, CASE WHEN num_open_accounts = 0 THEN NULL ELSE income / num_open_accounts END AS v FROM apps)
SELECT app_id, ROUND(COALESCE(v, (SELECT QUANTILE_CONT(v, 0.5) FROM x), 0), 6) AS income_per_account FROM x"""),
        "rule_violations": _apps("""
SELECT 'employment_years' AS field, COUNT(CASE WHEN employment_years > age - 14 THEN 1 END) AS violations FROM apps
UNION ALL SELECT 'credit_score', COUNT(CASE WHEN credit_score NOT BETWEEN 300 AND 850 THEN 1 END) FROM apps
UNION ALL SELECT 'income', COUNT(CASE WHEN income < 0 THEN 1 END) FROM apps"""),
        "label_conflicts": _apps("""
SELECT COUNT(*) AS rows, COUNT(CASE WHEN label_available = 0 AND months_observed >= 12 THEN 1 END) AS label_conflicts FROM apps"""),
        "age_bands": _apps("""
SELECT CASE WHEN age >= 18 AND age < 35 THEN '19-34' WHEN age >= 35 AND age < 50 THEN '35-49'
            WHEN age >= 50 AND age < 101 THEN '50+' END AS age_band, COUNT(*) AS rows, MIN(age) AS youngest, MAX(age) AS oldest
FROM apps GROUP BY 1"""),
        "quarter_bucket": """
SELECT CAST(YEAR(ts) AS VARCHAR) || 'Q' || CAST(QUARTER(ts) AS VARCHAR) AS quarter, COUNT(*) AS rows FROM events GROUP BY 1""",
        "apply_threshold": _scored("SELECT app_id, score, CAST(score >= 0.1e0 AS INT) AS predicted FROM scored"),
        "clipped_logit": _scored("""
SELECT app_id, ROUND(LN(LEAST(GREATEST(score, 1e-6), 1 - 1e-6) / (1 - LEAST(GREATEST(score, 1e-6), 1 - 1e-6))), 6) AS logit FROM scored"""),
        "readable_cell": _scored("""
SELECT state, channel, COUNT(*) AS rows, CAST(SUM(default_12m) AS BIGINT) AS positives,
       CASE WHEN COUNT(*) < 30 OR SUM(default_12m) < 3 THEN 'no, cell too small' ELSE 'yes' END AS readable
FROM scored GROUP BY state, channel"""),
    }


def _sets() -> dict[str, str]:
    groups = f"SELECT COUNT(*) AS n FROM apps GROUP BY {_SIG} HAVING COUNT(*) > 1"
    return {
        "duplicate_counts": _apps(f"""
SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows, COUNT(*) AS duplicate_groups,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS rows_removed FROM ({groups})"""),
        "duplicate_pairs": _apps(f"""
SELECT CAST(SUM(n) // 2 AS BIGINT) AS pairs, COUNT(*) AS "groups", CAST(SUM(n - 1) AS BIGINT) AS extra_rows FROM ({groups})"""),
        "duplicate_texts": """
SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows, COUNT(*) AS duplicate_groups,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS rows_removed
FROM (SELECT COUNT(*) AS n FROM documents GROUP BY text HAVING COUNT(*) > 1)""",
        "dedup_keep_first": _dedup("SELECT app_id, state, age, ROUND(credit_utilization, 6) AS credit_utilization, current_balance, months_observed, label_available FROM dedup"),
        "full_row_duplicates": _apps(f"""
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS full_row_duplicates FROM (SELECT COUNT(*) AS n FROM apps GROUP BY {", ".join(APPS.names)})"""),
        "repeated_ids": _apps("""
SELECT CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS rows_with_repeated_id,
       COUNT(CASE WHEN n > 1 THEN 1 END) AS repeated_ids
FROM (SELECT customer_id, COUNT(*) AS n FROM apps GROUP BY customer_id)"""),
        "cardinality": _apps("SELECT * FROM (" + _union(
            f"SELECT '{c}' AS field, COUNT(DISTINCT {c}) AS distinct_values FROM apps"
            for c in ("state", "customer_id", "app_id", "purpose")) + ")"),
        "partition_overlap": _split("""
, seen AS (SELECT customer_id, BOOL_OR(split = 'development') AS d, BOOL_OR(split = 'validation') AS v,
                  BOOL_OR(split = 'final_test') AS f FROM split GROUP BY customer_id)
SELECT COUNT(*) AS customers, COUNT(CASE WHEN d AND v THEN 1 END) AS development_validation,
       COUNT(CASE WHEN d AND f THEN 1 END) AS development_final_test, COUNT(CASE WHEN v AND f THEN 1 END) AS validation_final_test,
       COUNT(CASE WHEN (d AND v) OR (d AND f) OR (v AND f) THEN 1 END) AS shared_customers FROM seen"""),
        "stack_partitions": _split("""
SELECT split, app_id, default_12m FROM split WHERE split = 'development'
UNION ALL SELECT split, app_id, default_12m FROM split WHERE split = 'validation'
UNION ALL SELECT split, app_id, default_12m FROM split WHERE split = 'final_test'"""),
    }


def _aggregates() -> dict[str, str]:
    missing = _union(
        f"SELECT '{c}' AS field, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS missing, "
        f"ROUND((COUNT(*) - COUNT({c})) / COUNT(*), 6) AS missing_rate FROM apps" for c in APPS.names
    )
    by_outcome = _union(
        f"SELECT default_12m, '{c}' AS field, ROUND(AVG(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END), 6) AS missing_rate "
        f"FROM eligible GROUP BY default_12m" for c in ("income", "credit_score", "employment_years")
    )
    screen = _union(
        f"SELECT '{c}' AS field, COUNT(*) - COUNT({c}) AS missing, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS minimum, "
        f"ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS maximum, "
        + (f"COUNT(CASE WHEN {APPS.rules[c]} THEN 1 END)" if c in APPS.rules else "0")
        + f" AS rule_violations, ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.01), 6) AS p1, "
        f"ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.99), 6) AS p99, "
        + ("'withheld: breaks its rule'" if c in APPS.rules
           else "'kept'")
        + " AS treatment FROM apps"
        for c in APPS.screened
    )
    stats = _union(
        f"SELECT '{c}' AS field, ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5), 6) AS median, NULL AS mode FROM split WHERE split = 'development'"
        for c in APPS.numeric
    ) + "\nUNION ALL " + _union(
        f"SELECT '{c}', NULL, (SELECT {c} FROM split WHERE split = 'development' AND {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"
        for c in APPS.categorical
    )
    scale = _union(
        f"SELECT '{c}' AS field, ROUND(AVG({c}), 3) AS mean, "
        f"ROUND(CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END, 3) AS std FROM split WHERE split = 'development'"
        for c in APPS.numeric
    )
    age = """SELECT CASE WHEN age >= 18 AND age < 35 THEN '19-34' WHEN age >= 35 AND age < 50 THEN '35-49'
            WHEN age >= 50 AND age < 101 THEN '50+' END AS age_band, score,
       SUM(default_12m) AS pos, SUM(1 - default_12m) AS neg FROM scored GROUP BY 1, 2"""
    long = _union(f"SELECT '{d}' AS dimension, {x} AS level, score, default_12m FROM scored" for d, x in _PAIRS)
    one = "SELECT 1 AS g, score, SUM(default_12m) AS pos, SUM(1 - default_12m) AS neg FROM scored GROUP BY score"

    def item(population, name, expr, table):
        return f"SELECT '{population}' AS population, '{name}' AS audit_item, ROUND(CAST({expr} AS DOUBLE), 6) AS result FROM {table}"

    dup = f"(SELECT COUNT(*) AS n FROM apps GROUP BY {_SIG} HAVING COUNT(*) > 1)"
    audit = [
        item("raw", "rows", "COUNT(*)", "apps"),
        item("raw", "observed_targets", "COUNT(default_12m)", "apps"),
        item("raw", "missing_targets", "COUNT(*) - COUNT(default_12m)", "apps"),
        item("raw", "unavailable_labels_at_12_months", "COUNT(CASE WHEN label_available = 0 AND months_observed >= 12 THEN 1 END)", "apps"),
        item("raw", "implausible_employment_tenure", "COUNT(CASE WHEN employment_years > age - 14 THEN 1 END)", "apps"),
        item("raw", "missing_income", "COUNT(*) - COUNT(income)", "apps"),
        item("raw", "missing_credit_score", "COUNT(*) - COUNT(credit_score)", "apps"),
        item("raw", "missing_utilization", "COUNT(*) - COUNT(credit_utilization)", "apps"),
        item("raw", "income_minimum", "MIN(income)", "apps"),
        item("raw", "income_maximum", "MAX(income)", "apps"),
        item("raw", "credit_score_minimum", "MIN(credit_score)", "apps"),
        item("raw", "credit_score_maximum", "MAX(credit_score)", "apps"),
        item("raw", "observed_default_rate_1996", "AVG(CASE WHEN YEAR(application_date) = 1996 THEN default_12m END)", "apps"),
        item("raw", "observed_default_rate_2000", "AVG(CASE WHEN YEAR(application_date) = 2000 THEN default_12m END)", "apps"),
        item("raw", "label_availability_2001", "AVG(CASE WHEN YEAR(application_date) = 2001 THEN label_available END)", "apps"),
        item("eligible", "rows", "COUNT(*)", "eligible"),
        item("eligible", "positives", "SUM(default_12m)", "eligible"),
        item("eligible", "prevalence", "AVG(default_12m)", "eligible"),
        item("eligible", "missing_utilization_rate_among_defaults",
             "AVG(CASE WHEN default_12m = 1 THEN CASE WHEN credit_utilization IS NULL THEN 1e0 ELSE 0e0 END END)", "eligible"),
        item("eligible", "missing_utilization_rate_among_non_defaults",
             "AVG(CASE WHEN default_12m = 0 THEN CASE WHEN credit_utilization IS NULL THEN 1e0 ELSE 0e0 END END)", "eligible"),
        item("raw", "duplicate_rows", "COALESCE(SUM(n), 0)", dup),
        item("raw", "duplicate_groups", "COUNT(*)", dup),
        item("raw", "rows_removed", "COALESCE(SUM(n - 1), 0)", dup),
        item("raw", "full_row_duplicates", "0", "(SELECT 1)"),
        item("raw", "rows_with_repeated_id", "COUNT(*) - COUNT(DISTINCT app_id)", "apps"),
        item("raw", "repeated_ids", "COUNT(*) - COUNT(DISTINCT app_id)", "apps"),
        item("raw", "distinct_state", "COUNT(DISTINCT state)", "apps"),
        item("raw", "distinct_customer_id", "COUNT(DISTINCT customer_id)", "apps"),
        item("raw", "distinct_app_id", "COUNT(DISTINCT app_id)", "apps"),
        "SELECT split, 'rows', CAST(COUNT(*) AS DOUBLE) FROM split GROUP BY split",
        "SELECT split, 'positives', CAST(SUM(default_12m) AS DOUBLE) FROM split GROUP BY split",
    ]
    return {
        "label_maturity_by_quarter": _dedup(_MATURITY),
        "default_rate_by_year": _apps("""
SELECT CAST(YEAR(application_date) AS INT) AS year, COUNT(*) AS rows, ROUND(AVG(default_12m), 6) AS default_rate
FROM apps WHERE default_12m IS NOT NULL GROUP BY 1"""),
        "label_rate_for_year": _apps("""
SELECT COUNT(*) AS rows, ROUND(AVG(label_available), 6) AS label_rate FROM apps WHERE YEAR(application_date) = 2000"""),
        "missing_profile": _apps("SELECT * FROM (" + missing + ")"),
        "missing_by_outcome": _eligible("SELECT * FROM (" + by_outcome + ")"),
        "outlier_screen": _apps("SELECT * FROM (" + screen + ")"),
        "audit_table": _split("SELECT * FROM (" + _union(audit) + ")"),
        "population_summary": _eligible(_union(
            f"""SELECT '{name}' AS population, COUNT(*) AS rows, COUNT(default_12m) AS labelled,
       CAST(SUM(default_12m) AS BIGINT) AS positives, ROUND(AVG(default_12m), 6) AS prevalence FROM {table}"""
            for name, table in (("raw", "apps"), ("deduplicated", "dedup"), ("eligible", "eligible")))),
        "partition_summary": _split("""
SELECT split, COUNT(*) AS rows, CAST(SUM(default_12m) AS BIGINT) AS positives, CAST(MIN(application_date) AS VARCHAR) AS first_date,
       CAST(MAX(application_date) AS VARCHAR) AS last_date FROM split GROUP BY split"""),
        "binary_metrics": _with(f"SELECT {_METRIC_LIST} FROM metrics", _SCORED, f"cells AS ({one})",
                                _GROUP_METRICS.format(g="g", t="0.1e0")),
        "subgroup_age": _with(f"SELECT age_band, {_METRIC_LIST} FROM metrics", _SCORED, f"cells AS ({age})",
                              _GROUP_METRICS.format(g="age_band", t="0.1e0")),
        "subgroup_extended": _with("""
SELECT dimension, level, rows, positives, ROUND(positive_rate, 6) AS positive_rate, ROUND(mean_score, 6) AS mean_score,
       ROUND((tpos + fpos) / rows, 6) AS flag_rate, ROUND(roc_auc, 6) AS roc_auc,
       CASE WHEN rows < 30 OR positives < 3 THEN 'no, cell too small' ELSE 'yes' END AS readable FROM metrics""",
                                   _SCORED, f"long AS ({long})",
                                   "cells AS (SELECT dimension, level, score, SUM(default_12m) AS pos, SUM(1 - default_12m) AS neg FROM long GROUP BY 1, 2, 3)",
                                   _GROUP_METRICS.format(g="dimension, level", t="0.1e0")),
        "calibration_figures": _scored("""
SELECT home_ownership, COUNT(*) AS rows, CAST(SUM(default_12m) AS BIGINT) AS positives, ROUND(AVG(default_12m), 6) AS observed_rate,
       ROUND(AVG(score), 6) AS mean_score, ROUND(SUM(score) / NULLIF(SUM(default_12m), 0), 6) AS expected_over_observed,
       ROUND(AVG((score - default_12m) * (score - default_12m)), 6) AS brier_score,
       ROUND(AVG(default_12m) * (1 - AVG(default_12m)), 6) AS no_skill_brier
FROM scored GROUP BY home_ownership"""),
        "impute_stats": _split("SELECT * FROM (" + stats + ")"),
        "scale_stats": _split("SELECT * FROM (" + scale + ")"),
    }


def _ranks() -> dict[str, str]:
    return {
        "roc_auc": _ranked("SELECT ROUND(SUM(neg * (tp - pos / 2e0)) / (CAST(MAX(p) AS DOUBLE) * MAX(n)), 6) AS roc_auc FROM ranked"),
        "average_precision": _ranked("SELECT ROUND(SUM(pos * tp / (tp + fp)) / MAX(p), 6) AS pr_auc FROM ranked"),
        "hard_label_auc": _scored("""
SELECT ROUND((AVG(CASE WHEN default_12m = 1 THEN CASE WHEN score >= 0.1e0 THEN 1e0 ELSE 0e0 END END)
            + AVG(CASE WHEN default_12m = 0 THEN CASE WHEN score >= 0.1e0 THEN 0e0 ELSE 1e0 END END)) / 2, 6) AS roc_auc_of_decisions
FROM scored"""),
        "roc_curve": _ranked("SELECT score AS threshold, ROUND(fp / n, 6) AS false_positive_rate, ROUND(tp / p, 6) AS true_positive_rate FROM ranked"),
        "pr_curve": _ranked("SELECT score AS threshold, ROUND(tp / (tp + fp), 6) AS precision, ROUND(tp / p, 6) AS recall FROM ranked"),
        "calibration_bins": _scored("""
, e AS (SELECT QUANTILE_CONT(score, 0.2) AS a, QUANTILE_CONT(score, 0.4) AS b, QUANTILE_CONT(score, 0.6) AS c,
               QUANTILE_CONT(score, 0.8) AS d FROM scored)
SELECT CAST(a < score AS INT) + CAST(b < score AS INT) + CAST(c < score AS INT) + CAST(d < score AS INT) AS bin,
       COUNT(*) AS rows, ROUND(AVG(default_12m), 6) AS observed_rate, ROUND(AVG(score), 6) AS mean_score
FROM scored, e GROUP BY 1"""),
        "score_histogram": _scored("""
, s AS (SELECT MIN(score) AS a, MAX(score) AS b, (MAX(score) - MIN(score)) / 14 AS w FROM scored),
c AS (SELECT CAST(LEAST(FLOOR((score - a) / w), 13) AS INT) AS bin, COUNT(*) AS n FROM scored, s GROUP BY 1)
SELECT CAST(r.i AS INT) AS bin, ROUND(a + r.i * w, 6) AS low, ROUND(a + (r.i + 1) * w, 6) AS high, COALESCE(n, 0) AS rows
FROM RANGE(14) r(i) LEFT JOIN c ON c.bin = r.i, s"""),
        "threshold_sweep": _scored("""
, t AS (SELECT i / 100e0 AS threshold FROM RANGE(5, 96) r(i)),
m AS (SELECT threshold, COUNT(*) AS n, SUM(CASE WHEN score >= threshold THEN default_12m ELSE 0 END) AS tp,
             SUM(CASE WHEN score >= threshold THEN 1 - default_12m ELSE 0 END) AS fp, SUM(default_12m) AS p
      FROM scored, t GROUP BY threshold)
SELECT threshold, ROUND((tp + (n - p) - fp) / n, 6) AS accuracy,
       ROUND(CASE WHEN tp + fp + p = 0 THEN 0 ELSE 2 * tp / (tp + fp + p) END, 6) AS f1 FROM m"""),
        "chronological_split": _split("SELECT app_id, split FROM split"),
        "chronological_cut": _eligible("""
SELECT app_id, CASE WHEN ROW_NUMBER() OVER (ORDER BY application_date, app_id) - 1 < CAST(FLOOR(COUNT(*) OVER () * 0.75e0) AS BIGINT)
                    THEN 'train' ELSE 'test' END AS part FROM eligible"""),
        "time_series_folds": _blocked(_union(f"""
SELECT {f} AS fold, COUNT(CASE WHEN block < {f} THEN 1 END) AS train_rows,
       CAST(SUM(CASE WHEN block < {f} THEN default_12m ELSE 0 END) AS BIGINT) AS train_positives,
       COUNT(CASE WHEN block = {f} THEN 1 END) AS validation_rows,
       CAST(SUM(CASE WHEN block = {f} THEN default_12m ELSE 0 END) AS BIGINT) AS validation_positives,
       CAST(MAX(CASE WHEN block < {f} THEN application_date END) = MIN(CASE WHEN block = {f} THEN application_date END) AS INT) AS shares_first_day
FROM blocked""" for f in (1, 2, 3))),
        "row_ordinal": _eligible("SELECT app_id, ROW_NUMBER() OVER (ORDER BY application_date, app_id) - 1 AS ordinal FROM eligible"),
    }


_OVER = """
ordered AS (SELECT app_id, ROW_NUMBER() OVER (ORDER BY app_id) - 1 AS ordinal FROM eligible WHERE default_12m = 1),
counts AS (SELECT SUM(default_12m) AS p, SUM(1 - default_12m) AS n FROM eligible),
draws AS (SELECT i, CAST('0x' || SUBSTR(MD5('7:' || i), 1, 15) AS BIGINT) % p AS ordinal
          FROM counts, RANGE((SELECT CAST(n - p AS BIGINT) FROM counts)) r(i)),
copies AS (SELECT app_id, ROW_NUMBER() OVER (PARTITION BY ordinal ORDER BY i) AS copy_no FROM draws JOIN ordered USING (ordinal)),
balanced AS MATERIALIZED (
  SELECT app_id AS source_row_id, 0 AS copy_no, default_12m FROM eligible
  UNION ALL SELECT app_id, copy_no, 1 FROM copies),
hashed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY MD5('7:' || source_row_id || ':' || copy_no)) AS h, COUNT(*) OVER () AS n FROM balanced),
parted AS MATERIALIZED (SELECT *, CASE WHEN h <= CEIL(n * 0.25e0) THEN 'test' ELSE 'train' END AS part FROM hashed)"""


def _sampling() -> dict[str, str]:
    def over(body: str) -> str:
        return _with(body, _DEDUP, _ELIGIBLE, _OVER)

    boot = """
strata AS (SELECT score, default_12m AS y, ROW_NUMBER() OVER (PARTITION BY default_12m ORDER BY app_id) - 1 AS ordinal,
                  COUNT(*) OVER (PARTITION BY default_12m) AS n FROM scored),
draws AS (SELECT rep, y, j, CAST('0x' || SUBSTR(MD5('42:' || rep || ':' || y || ':' || j), 1, 15) AS BIGINT) % n AS ordinal
          FROM (SELECT y, MAX(n) AS n FROM strata GROUP BY y), RANGE(2000) a(rep), RANGE((SELECT MAX(n) FROM strata)) b(j) WHERE j < n),
cells AS (SELECT rep, score, SUM(y) AS pos, SUM(1 - y) AS neg FROM draws JOIN strata USING (y, ordinal) GROUP BY rep, score),
ranked AS (SELECT *, SUM(pos) OVER (PARTITION BY rep ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
                  SUM(neg) OVER (PARTITION BY rep ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM cells),
m AS MATERIALIZED (SELECT rep, SUM(neg * (tp - pos / 2e0)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS roc_auc,
             SUM(pos * tp / (tp + fp)) / SUM(pos) AS pr_auc,
             SUM(pos * (1 - score) * (1 - score) + neg * score * score) / SUM(pos + neg) AS brier_score FROM ranked GROUP BY rep)"""
    return {
        "gather_rows": over("SELECT app_id, copy_no FROM copies"),
        "oversample_minority": over("SELECT source_row_id, copy_no, default_12m FROM balanced"),
        "random_split_exact": over("SELECT source_row_id, copy_no, part FROM parted"),
        "random_split_approximate": _apps("""
SELECT app_id, CASE WHEN CAST('0x' || SUBSTR(MD5('7:' || app_id), 1, 15) AS BIGINT) < (1::BIGINT << 58) THEN 'test' ELSE 'train' END AS part FROM apps"""),
        "train_test_contamination": over("""
, seen AS (SELECT source_row_id, COUNT(CASE WHEN part = 'train' THEN 1 END) AS a, COUNT(CASE WHEN part = 'test' THEN 1 END) AS b,
             COUNT(CASE WHEN part = 'test' AND default_12m = 1 THEN 1 END) AS c FROM parted GROUP BY 1)
SELECT CAST(SUM(b) AS BIGINT) AS test_rows, CAST(SUM(c) AS BIGINT) AS test_positives,
       CAST(SUM(CASE WHEN a > 0 THEN b ELSE 0 END) AS BIGINT) AS contaminated_rows,
       CAST(SUM(CASE WHEN a > 0 THEN c ELSE 0 END) AS BIGINT) AS contaminated_positives,
       COUNT(CASE WHEN b > 0 THEN 1 END) AS unique_test_sources,
       ROUND(SUM(CASE WHEN a > 0 THEN b ELSE 0 END) / SUM(b), 6) AS contaminated_rate FROM seen"""),
        "bootstrap_ci": _with(_union(
            f"SELECT '{c}' AS metric, ROUND(QUANTILE_CONT({c}, 0.025), 6) AS ci_low, ROUND(QUANTILE_CONT({c}, 0.975), 6) AS ci_high FROM m"
            for c in ("roc_auc", "pr_auc", "brier_score")), _SCORED, boot),
    }


_LEVELS = {
    "home_ownership": ["F", "O", "P"],
    "purpose": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "channel": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}


def _level_name(column: str, level: str) -> str:
    return f"{column}_" + level.replace("-", "_").replace(" ", "_")


def _prepared(table: str, fit: str, keep: str, flags: bool, rates: bool) -> str:
    """Fill, encode and scale ``table`` with statistics of ``fit``."""
    ctes, fills = [], []
    for c in APPS.numeric:
        fills.append(f"(SELECT QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5) FROM {fit}) AS fill_{c}")
    for c in APPS.categorical:
        fills.append(f"(SELECT {c} FROM {fit} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS fill_{c}")
    ctes.append("fills AS MATERIALIZED (SELECT " + ", ".join(fills) + f", (SELECT AVG(default_12m) FROM {fit}) AS base_rate)")
    if rates:
        ctes += [f"rate_{c} AS (SELECT {c}, AVG(default_12m) AS r FROM {fit} GROUP BY {c})" for c in APPS.categorical]
    cols, names, plain = [], [], []
    for c in APPS.numeric:
        cols.append(f"COALESCE(CAST(t.{c} AS DOUBLE), fill_{c}) AS v_{c}")
        names.append(c)
    for c in ("income", "credit_score") if flags else ():
        cols.append(f"CASE WHEN t.{c} IS NULL THEN 1e0 ELSE 0e0 END AS v_{c}_missing")
        names.append(f"{c}_missing")
    for c in APPS.categorical:
        if rates:
            cols.append(f"COALESCE(rate_{c}.r, base_rate) AS v_{c}_target_rate")
            names.append(f"{c}_target_rate")
        for level in _LEVELS[c][1:] if rates else _LEVELS[c]:
            name = _level_name(c, level)
            cols.append(f"CASE WHEN COALESCE(t.{c}, fill_{c}) = '{level}' THEN 1e0 ELSE 0e0 END AS v_{name}")
            (names if rates else plain).append(name)
    joins = "".join(f" LEFT JOIN rate_{c} ON rate_{c}.{c} = t.{c}" for c in APPS.categorical) if rates else ""
    ctes.append(f"made AS MATERIALIZED (SELECT t.app_id, {keep} AS part, " + ", ".join(cols) + f" FROM {table} t CROSS JOIN fills{joins})")
    of_fit = "WHERE part = 'development'" if fit != table else ""
    ctes.append("scales AS MATERIALIZED (SELECT " + ", ".join(
        f"AVG(v_{n}) AS m_{n}, CASE WHEN STDDEV_POP(v_{n}) = 0 THEN 1 ELSE STDDEV_POP(v_{n}) END AS s_{n}" for n in names
    ) + f" FROM made {of_fit})")
    shown = [f"ROUND((v_{n} - m_{n}) / s_{n}, 6) AS {n}" for n in names] + [f"v_{n} AS {n}" for n in plain]
    lead = "app_id, part AS split, " if flags else "app_id, "
    return ", " + ", ".join(ctes) + f"\nSELECT {lead}" + ", ".join(shown) + " FROM made CROSS JOIN scales"


def _relevance(table: str, columns: list[str]) -> str:
    """Mutual information of each column, cut at its tenths, with the target."""
    mi = []
    for c in columns:
        edges = " + ".join(
            f"CASE WHEN {c} > (SELECT QUANTILE_CONT(CAST({c} AS DOUBLE), 0.{i}) FROM {table}) THEN 1 ELSE 0 END" for i in range(1, 10)
        )
        # Equal edges count more than once here, which renames bins but does not merge or split them.
        mi.append(f"SELECT '{c}' AS feature, CASE WHEN {c} IS NOT NULL THEN {edges} END AS bin, default_12m AS y FROM {table}")
    return f"""
, long AS MATERIALIZED ({_union(mi)}),
cells AS (SELECT feature, bin, y, COUNT(*) AS n FROM long GROUP BY 1, 2, 3),
margins AS (SELECT *, SUM(n) OVER (PARTITION BY feature) AS t, SUM(n) OVER (PARTITION BY feature, bin) AS b,
                   SUM(n) OVER (PARTITION BY feature, y) AS k FROM cells),
relevance AS (SELECT feature, ROUND(SUM(n / t * LN(n * t / (b * CAST(k AS DOUBLE)))), 6) AS mutual_information FROM margins GROUP BY feature)"""


def _preparation() -> dict[str, str]:
    dev = ", development AS MATERIALIZED (SELECT * FROM split WHERE split = 'development')\n"
    dummies = [f"CAST(purpose = '{v}' AS INT) AS {_level_name('purpose', v)}" for v in _LEVELS["purpose"]]
    relevance = _relevance("eligible", list(APPS.numeric))
    whole = _prepared("eligible", "eligible", "'all'", False, True)
    made, shown = whole[: whole.rindex("\nSELECT ")], whole[whole.rindex("\nSELECT ") :]
    columns = list(APPS.numeric)
    for c in APPS.categorical:
        columns += [f"{c}_target_rate", *(_level_name(c, v) for v in _LEVELS[c][1:])]
    prepared = f"""{made},
prepared AS MATERIALIZED (SELECT p.*, default_12m FROM ({shown}) p JOIN eligible USING (app_id))"""
    attribution = """
SELECT app_id, default_12m, age, state, ROUND(income, 6) AS income, ROUND(employment_years, 6) AS employment_years,
       credit_score, loan_amount, ROUND(interest_rate, 6) AS interest_rate, term_months, home_ownership, purpose, channel,
       num_open_accounts, debt_to_income, ROUND(credit_utilization, 6) AS credit_utilization,
       CAST(customer_id AS DOUBLE) AS customer_number, CAST(YEAR(application_date) AS INT) AS application_year,
       CAST(MONTH(application_date) AS INT) AS application_month, CAST(DAY(application_date) AS INT) AS application_day,
       CAST((DAYOFWEEK(application_date) + 6) % 7 AS INT) AS application_dayofweek,
       ROUND(loan_amount / NULLIF(income, 0), 6) AS loan_to_income
FROM apps WHERE default_12m IS NOT NULL"""
    return {
        "target_encode_full": _apps("""
SELECT app_id, ROUND(AVG(COALESCE(default_12m, 0)) OVER (PARTITION BY purpose), 6) AS purpose_target_rate FROM apps"""),
        "target_encode_train": _split(dev + """
, rates AS (SELECT customer_id, AVG(default_12m) AS r FROM development GROUP BY customer_id)
SELECT app_id, ROUND(COALESCE(r, (SELECT AVG(default_12m) FROM development)), 6) AS customer_id_target_rate
FROM split LEFT JOIN rates USING (customer_id)"""),
        "train_only_preprocess": _split(dev + _prepared("split", "development", "t.split", True, False)),
        "whole_sample_preprocess": _eligible(_prepared("eligible", "eligible", "'all'", False, True)),
        "train_only_encode": _split(dev + _prepared("split", "development", "t.split", False, True)),
        "one_hot": _eligible("SELECT app_id, " + ", ".join(dummies) + " FROM eligible"),
        "dummies_drop_first": _eligible("SELECT app_id, " + ", ".join(dummies[1:]) + " FROM eligible"),
        "class_weights": _eligible("""
SELECT default_12m, COUNT(*) AS rows, ROUND((SELECT COUNT(*) FROM eligible) / (2e0 * COUNT(*)), 6) AS weight FROM eligible GROUP BY default_12m"""),
        "mutual_information": _eligible(relevance + "\nSELECT * FROM relevance"),
        "top_features": _eligible(prepared + _relevance("prepared", columns) + """
SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY mutual_information DESC, feature) AS INT) AS place FROM relevance) WHERE place <= 35"""),
        "attribution_frame": _apps(attribution),
        "order_by_time": _eligible("SELECT app_id, CAST(application_date AS VARCHAR) AS application_date FROM eligible"),
        "stable_date_sort": _apps("SELECT app_id, ROW_NUMBER() OVER (ORDER BY application_date, app_id) - 1 AS ordinal FROM apps"),
    }


def _selection() -> dict[str, str]:
    cards = _union(
        f"SELECT {a}e0 AS c, block AS fold, default_12m, "
        f"ROUND(1e0 / (1e0 + EXP(1.5e0 + {a}e0 * num_open_accounts - 4e0 * debt_to_income)), 6) AS score FROM blocked WHERE block >= 1"
        for a in (0.2, 0.35, 0.5, 0.7)
    )
    cells = "cells AS (SELECT c, fold, score, SUM(default_12m) AS pos, SUM(1 - default_12m) AS neg FROM cards GROUP BY 1, 2, 3)"
    folds = _GROUP_METRICS.format(g="c, fold", t="0.5e0")
    base = (_DEDUP, _ELIGIBLE, _PLACED, f"cards AS MATERIALIZED ({cards})", cells, folds)
    summary = """summary AS MATERIALIZED (
  SELECT c AS C, AVG(pr_auc) AS mean_pr_auc, STDDEV_SAMP(pr_auc) AS std_pr_auc, AVG(roc_auc) AS mean_roc_auc,
         AVG(brier_score) AS mean_brier_score FROM metrics GROUP BY c)"""
    segments = "SELECT home_ownership, score, default_12m FROM scored"
    cuts = _union(
        f"SELECT home_ownership, {i} AS place, 'cut {t}' AS model, default_12m AS y, CAST(score >= {t}e0 AS INT) AS d FROM scored"
        for i, t in enumerate((0.3, 0.1, 0.2))
    )
    return {
        "cv_summary": _with("""
SELECT C, 'None' AS class_weight, ROUND(mean_pr_auc, 6) AS mean_pr_auc, ROUND(std_pr_auc, 6) AS std_pr_auc,
       ROUND(mean_roc_auc, 6) AS mean_roc_auc, ROUND(mean_brier_score, 6) AS mean_brier_score, 3 AS fold_detail FROM summary""", *base, summary),
        "tolerance_select": _with("""
, near AS (SELECT *, mean_pr_auc >= (SELECT MAX(mean_pr_auc) FROM summary) - 0.01e0 AS near FROM summary)
SELECT C, ROUND(mean_pr_auc, 6) AS mean_pr_auc, ROUND(mean_brier_score, 6) AS mean_brier_score,
       CAST(near AND ROW_NUMBER() OVER (PARTITION BY near ORDER BY mean_brier_score, C) = 1 AS INT) AS selected FROM near""", *base, summary),
        "seed_summary": _with("""
SELECT home_ownership, ROUND(AVG(auc), 6) AS mean_roc_auc, ROUND(MIN(auc), 6) AS seed_minimum, ROUND(MAX(auc), 6) AS seed_maximum,
       COUNT(auc) AS seeds FROM runs GROUP BY home_ownership""", _SCORED, """
cells AS (SELECT home_ownership, seed, score, SUM(default_12m) AS pos, SUM(1 - default_12m) AS neg
          FROM scored, (VALUES (7), (8), (9), (10), (11)) s(seed)
          WHERE CAST('0x' || SUBSTR(MD5(seed || ':' || app_id), 1, 15) AS BIGINT) < (1::BIGINT << 58) GROUP BY 1, 2, 3),
ranked AS (SELECT *, SUM(pos) OVER (PARTITION BY home_ownership, seed ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp FROM cells),
runs AS (SELECT home_ownership, seed, SUM(neg * (tp - pos / 2e0)) / NULLIF(CAST(SUM(pos) AS DOUBLE) * SUM(neg), 0) AS auc FROM ranked GROUP BY 1, 2)"""),
        "champion_select": _with("""
SELECT home_ownership, place, model, accuracy, roc_auc_of_decisions FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY home_ownership ORDER BY accuracy DESC, roc_auc_of_decisions DESC, place) AS rn FROM scores) WHERE rn = 1""",
                                 _SCORED, f"""cuts AS ({cuts}),
scores AS (SELECT home_ownership, place, model, ROUND(AVG(CASE WHEN y = d THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
   ROUND((AVG(CASE WHEN y = 1 THEN CAST(d AS DOUBLE) END) + AVG(CASE WHEN y = 0 THEN 1e0 - d END)) / 2, 6) AS roc_auc_of_decisions
   FROM cuts GROUP BY 1, 2, 3)"""),
        "best_threshold": _with("""
SELECT home_ownership, threshold, accuracy, f1 FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY home_ownership ORDER BY accuracy DESC, f1 DESC, threshold) AS rn FROM sweep) WHERE rn = 1""",
                                _SCORED, f"""segments AS ({segments}),
t AS (SELECT i / 100e0 AS threshold FROM RANGE(5, 96) r(i)),
m AS (SELECT home_ownership, threshold, COUNT(*) AS n, SUM(CASE WHEN score >= threshold THEN default_12m ELSE 0 END) AS tp,
             SUM(CASE WHEN score >= threshold THEN 1 - default_12m ELSE 0 END) AS fp, SUM(default_12m) AS p
      FROM segments, t GROUP BY 1, 2),
sweep AS (SELECT home_ownership, threshold, ROUND((tp + (n - p) - fp) / n, 6) AS accuracy,
                 ROUND(CASE WHEN tp + fp + p = 0 THEN 0 ELSE 2 * tp / (tp + fp + p) END, 6) AS f1 FROM m)"""),
        "recall_threshold": _scored("SELECT home_ownership, MIN(score) AS threshold FROM scored WHERE default_12m = 1 GROUP BY home_ownership"),
    }


def _line(cells: str, key: str) -> str:
    """Thirty Newton steps of the outcome on the logit, per key of the cells."""
    return f"""
cells AS MATERIALIZED ({cells}),
line AS (
  SELECT DISTINCT 0 AS step, {key}, 0e0 AS b0, 0e0 AS b1 FROM cells
  UNION ALL
  SELECT step + 1, {key}, b0 + (h2 * g0 - h1 * g1) / (h0 * h2 - h1 * h1), b1 + (h0 * g1 - h1 * g0) / (h0 * h2 - h1 * h1)
  FROM (SELECT step, {key}, b0, b1, SUM(pos - n * p) AS g0, SUM((pos - n * p) * x) AS g1, SUM(n * p * (1 - p)) AS h0,
               SUM(n * p * (1 - p) * x) AS h1, SUM(n * p * (1 - p) * x * x) AS h2
        FROM (SELECT line.*, x, pos, n, 1e0 / (1e0 + EXP(-(b0 + b1 * x))) AS p FROM line JOIN cells USING ({key}) WHERE step < 30)
        GROUP BY step, {key}, b0, b1)
)"""


def _models() -> dict[str, str]:
    x = "LN(GREATEST(LEAST(score, 1 - 1e-6), 1e-6) / (1 - GREATEST(LEAST(score, 1 - 1e-6), 1e-6)))"
    cells = f"SELECT {{}}, {x} AS x, SUM(default_12m) AS pos, COUNT(*) AS n FROM {{}} GROUP BY 1, 2"
    shown = "ROUND(b0, 6) AS calibration_intercept, ROUND(b1, 6) AS calibration_slope"
    scored = "*, ROUND(1e0 / (1e0 + EXP(1.5e0 + 0.35e0 * num_open_accounts - 4e0 * debt_to_income)), 6) AS score"
    return {
        "calibration_fit": _with(f"SELECT {shown} FROM line WHERE step = 30", _SCORED, _line(cells.format("1 AS k", "scored"), "k")).replace("WITH", "WITH RECURSIVE", 1),
        "calibration_summary": _with(
            f"""
SELECT sample, rows, positives, ROUND(observed_rate, 6) AS observed_rate, ROUND(mean_score, 6) AS mean_score,
       ROUND(expected_over_observed, 6) AS expected_over_observed, ROUND(brier_score, 6) AS brier_score,
       ROUND(observed_rate * (1 - observed_rate), 6) AS no_skill_brier, {shown}
FROM (SELECT sample, COUNT(*) AS rows, CAST(SUM(default_12m) AS BIGINT) AS positives, AVG(default_12m) AS observed_rate, AVG(score) AS mean_score,
             SUM(score) / NULLIF(SUM(default_12m), 0) AS expected_over_observed, AVG((score - default_12m) * (score - default_12m)) AS brier_score
      FROM held GROUP BY sample) JOIN line USING (sample) WHERE step = 30""",
            _DEDUP, _ELIGIBLE, _SPLIT, f"held AS MATERIALIZED (SELECT split AS sample, {scored} FROM split WHERE split <> 'development')",
            _line(cells.format("sample", "held"), "sample")).replace("WITH", "WITH RECURSIVE", 1),
    }


def _near() -> dict[str, str]:
    cols = APPS.near_duplicate
    fills = ", ".join(f"(SELECT QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5) FROM apps) AS fill_{c}" for c in cols)
    filled = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), fill_{c}) AS v{i}" for i, c in enumerate(cols))

    def scaled(table: str) -> str:
        parts = ", ".join(f"(v{i} - AVG(v{i}) OVER ()) / STDDEV_POP(v{i}) OVER () AS x{i}" for i in range(len(cols)))
        return f"SELECT app_id, {parts} FROM {table}"

    square = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(len(cols)))

    def nearest(table: str) -> str:
        return f"SELECT a.app_id, SQRT(MIN({square})) AS d FROM {table} a JOIN {table} b ON a.app_id <> b.app_id GROUP BY a.app_id"

    within = _union(
        f"SELECT 'rows_within_{f'{c:.2f}'.replace('.', '_')}', CAST(COUNT(CASE WHEN d < {c}e0 THEN 1 END) AS DOUBLE) FROM near_all" for c in (0.01, 0.05, 0.10, 0.25)
    )
    squares = " + ".join(f"(a.embedding[{i}]::DOUBLE - b.embedding[{i}]::DOUBLE) * (a.embedding[{i}]::DOUBLE - b.embedding[{i}]::DOUBLE)" for i in range(1, 65))
    return {
        "near_duplicate_screen": _with(f"""
SELECT 'exact_duplicate_pairs' AS "check", CAST(SUM(n) // 2 AS DOUBLE) AS value
FROM (SELECT COUNT(*) AS n FROM apps GROUP BY {_SIG} HAVING COUNT(*) > 1)
UNION ALL SELECT 'median_nearest_distance', ROUND(QUANTILE_CONT(d, 0.5), 6) FROM near_all
UNION ALL {within}
UNION ALL SELECT 'rows_within_0_10_after_removal', CAST(COUNT(CASE WHEN d < 0.10e0 THEN 1 END) AS DOUBLE) FROM near_left""",
                                       _DEDUP, f"""fills AS MATERIALIZED (SELECT {fills}),
filled AS MATERIALIZED (SELECT app_id, {filled} FROM apps CROSS JOIN fills),
filled_left AS MATERIALIZED (SELECT * FROM filled SEMI JOIN dedup USING (app_id)),
all_points AS MATERIALIZED ({scaled("filled")}), left_points AS MATERIALIZED ({scaled("filled_left")}),
near_all AS MATERIALIZED ({nearest("all_points")}), near_left AS MATERIALIZED ({nearest("left_points")})"""),
        "embedding_neighbours": f"""
SELECT a.vec_id, 1 AS copies, ROUND(SQRT(MIN({squares})), 5) AS distance
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY a.vec_id""",
    }


def _reports(twins: dict[str, str]) -> str:
    """Rows, filled cells and columns of each report, from its own twin."""
    score_rows = _scored("""
SELECT app_id, CAST(application_date AS VARCHAR) AS application_date, age, state, default_12m,
       score AS probability_default, 0.1e0 AS threshold, CAST(score >= 0.1e0 AS INT) AS predicted_default FROM scored""")
    parts = []
    for name in REPORT_NAMES:
        sql = score_rows if name == "score_rows" else twins[name]
        parts.append(f"""SELECT '{name}' AS report, (SELECT COUNT(*) FROM ({sql})) AS rows, COUNT(*) AS filled_cells, CAST(COUNT(DISTINCT name) AS INT) AS columns
FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM ({sql})) ON COLUMNS(*) INTO NAME name VALUE cell)""")
    return "\nUNION ALL\n".join(parts)


REPORT_NAMES = (
    "field_dictionary", "audit_table", "outlier_screen", "near_duplicate_screen", "label_maturity_by_quarter",
    "population_summary", "partition_summary", "cv_summary", "threshold_sweep", "subgroup_age", "subgroup_extended",
    "calibration_summary", "top_features", "score_rows",
)


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (_sources, _projections, _sets, _aggregates, _ranks, _sampling, _preparation, _selection, _models, _near):
        out.update(part())
    out["report_sink"] = _reports(out)
    return out
