"""Field dictionaries of the application tables and the roles fields play."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ID = "IDENTIFIER"
KNOWN = "KNOWN_AT_DECISION_TIME"
PROXY = "POTENTIAL_PROXY"
POST = "POST_DECISION"
UNCLEAR = "UNCLEAR"
OUTCOME = "OUTCOME_DERIVED"
MACRO = "MACRO"

_REASONS = {
    ID: "names a row or its owner",
    KNOWN: "on record when the application came in",
    PROXY: "can reveal a protected group",
    POST: "arises after the decision",
    UNCLEAR: "its date or quality is in doubt",
    OUTCOME: "follows from the outcome",
    MACRO: "state of the economy",
}

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    tags: tuple[str, ...]

    @property
    def rationale(self) -> str:
        """What the tags say about the field."""
        return "; ".join(_REASONS[t] for t in self.tags)


@dataclass(frozen=True)
class ApplicationSchema:
    """What each column of an application table is, and what it may be used for."""

    fields: tuple[Field, ...]
    row_id: str
    customer: str
    date: str
    target: str
    label_flag: str
    months: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    audit_only: tuple[str, ...]
    # Columns a faulty design would use although they come from after the decision.
    leaked: tuple[str, ...]
    # Columns that follow from the others and so need no place in the signature.
    dependent: tuple[str, ...] = ()
    screened: tuple[str, ...] = ()
    near_duplicate: tuple[str, ...] = ()
    # field -> SQL predicate that marks an implausible row
    rules: dict = field(default_factory=dict)
    income: str = ""
    amount: str = ""
    balance: str = ""
    later_income: str = ""
    score: str = "credit_score"
    withheld: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def signature(self) -> list[str]:
        """Columns on which copies of one application agree."""
        skip = {self.row_id, *self.dependent}
        return [n for n in self.names if n not in skip]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, _TYPES[f.type], True) for f in self.fields])

    def role(self, name: str) -> str:
        if name in self.features:
            return "Predictor"
        return "Eligibility/split/audit only" if name in self.audit_only else "Excluded"


def _fields(text: str) -> tuple[Field, ...]:
    out = []
    for line in text.strip().splitlines():
        name, kind, tags = (part.strip() for part in line.split("|"))
        out.append(Field(name, kind, tuple(t.strip() for t in tags.split(";"))))
    return tuple(out)


# The 35 fields of a loan-book extract, their types and timing tags.
LOAN_BOOK = ApplicationSchema(
    fields=_fields("""
        customer_id                    | string | IDENTIFIER
        application_date               | date   | KNOWN_AT_DECISION_TIME
        age                            | int    | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        state                          | string | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        zip_prefix                     | string | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        annual_income_at_application   | double | KNOWN_AT_DECISION_TIME
        current_income                 | double | POST_DECISION; UNCLEAR
        employment_years               | double | KNOWN_AT_DECISION_TIME; UNCLEAR
        credit_score                   | double | KNOWN_AT_DECISION_TIME
        debt_to_income                 | double | KNOWN_AT_DECISION_TIME
        loan_amount                    | double | KNOWN_AT_DECISION_TIME
        interest_rate                  | double | UNCLEAR
        term_months                    | int    | KNOWN_AT_DECISION_TIME
        home_ownership                 | string | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        purpose                        | string | KNOWN_AT_DECISION_TIME
        channel                        | string | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        num_open_accounts              | int    | KNOWN_AT_DECISION_TIME
        delinq_2y                      | int    | KNOWN_AT_DECISION_TIME
        inq_6m                         | int    | KNOWN_AT_DECISION_TIME
        credit_utilization             | double | KNOWN_AT_DECISION_TIME
        prior_defaults                 | int    | KNOWN_AT_DECISION_TIME
        bankruptcy_flag                | int    | KNOWN_AT_DECISION_TIME
        unemployment_rate              | double | KNOWN_AT_DECISION_TIME; MACRO
        prime_rate                     | double | KNOWN_AT_DECISION_TIME; MACRO
        manual_review_flag             | int    | POST_DECISION; UNCLEAR; POTENTIAL_PROXY
        underwriter_score              | double | POST_DECISION; UNCLEAR; POTENTIAL_PROXY
        model_version                  | string | IDENTIFIER; UNCLEAR
        months_observed                | double | POST_DECISION; OUTCOME_DERIVED
        label_available                | int    | POST_DECISION; OUTCOME_DERIVED
        days_past_due_6m_after         | int    | POST_DECISION; OUTCOME_DERIVED
        collections_contacted_9m_after | int    | POST_DECISION; OUTCOME_DERIVED
        charged_off_amount_12m         | double | POST_DECISION; OUTCOME_DERIVED
        account_status_12m             | string | POST_DECISION; OUTCOME_DERIVED
        current_balance                | double | POST_DECISION; UNCLEAR
        default_12m                    | int    | OUTCOME_DERIVED
    """),
    row_id="customer_id",
    customer="customer_id",
    date="application_date",
    target="default_12m",
    label_flag="label_available",
    months="months_observed",
    numeric=(
        "annual_income_at_application", "credit_score", "debt_to_income", "loan_amount",
        "term_months", "num_open_accounts", "delinq_2y", "inq_6m", "credit_utilization",
        "prior_defaults", "bankruptcy_flag", "unemployment_rate", "prime_rate",
    ),
    categorical=("home_ownership", "purpose", "channel"),
    audit_only=("customer_id", "application_date", "months_observed", "label_available", "age", "state"),
    leaked=(
        "days_past_due_6m_after", "collections_contacted_9m_after", "charged_off_amount_12m",
        "account_status_12m", "current_balance", "current_income", "months_observed",
        "label_available",
    ),
    screened=(
        "age", "annual_income_at_application", "employment_years", "credit_score",
        "debt_to_income", "loan_amount", "interest_rate", "credit_utilization",
        "num_open_accounts", "delinq_2y", "inq_6m",
    ),
    near_duplicate=(
        "age", "annual_income_at_application", "credit_score", "debt_to_income",
        "loan_amount", "interest_rate", "credit_utilization", "num_open_accounts",
    ),
    rules={"employment_years": "employment_years > age - 14"},
    income="annual_income_at_application",
    amount="loan_amount",
    balance="current_balance",
    later_income="current_income",
    withheld=("employment_years", "interest_rate"),
)


# The application table derived from the order tables (see sources.applications).
APPS = ApplicationSchema(
    fields=_fields("""
        app_id             | bigint | IDENTIFIER
        customer_id        | bigint | IDENTIFIER
        application_date   | date   | KNOWN_AT_DECISION_TIME
        age                | int    | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        state              | int    | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        income             | double | KNOWN_AT_DECISION_TIME
        employment_years   | double | KNOWN_AT_DECISION_TIME; UNCLEAR
        credit_score       | double | KNOWN_AT_DECISION_TIME
        loan_amount        | double | KNOWN_AT_DECISION_TIME
        interest_rate      | double | UNCLEAR
        term_months        | int    | KNOWN_AT_DECISION_TIME
        home_ownership     | string | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        purpose            | string | KNOWN_AT_DECISION_TIME
        channel            | string | KNOWN_AT_DECISION_TIME; POTENTIAL_PROXY
        num_open_accounts  | int    | KNOWN_AT_DECISION_TIME
        debt_to_income     | double | KNOWN_AT_DECISION_TIME
        credit_utilization | double | KNOWN_AT_DECISION_TIME
        returned_value_12m | double | POST_DECISION; OUTCOME_DERIVED
        current_balance    | double | POST_DECISION; UNCLEAR
        months_observed    | int    | POST_DECISION; OUTCOME_DERIVED
        label_available    | int    | POST_DECISION; OUTCOME_DERIVED
        default_12m        | int    | OUTCOME_DERIVED
    """),
    row_id="app_id",
    customer="customer_id",
    date="application_date",
    target="default_12m",
    label_flag="label_available",
    months="months_observed",
    numeric=(
        "income", "credit_score", "debt_to_income", "loan_amount", "term_months",
        "num_open_accounts", "credit_utilization",
    ),
    categorical=("home_ownership", "purpose", "channel"),
    audit_only=(
        "app_id", "customer_id", "application_date", "months_observed", "label_available",
        "age", "state",
    ),
    leaked=("returned_value_12m", "current_balance", "months_observed", "label_available"),
    dependent=(
        "state", "age", "credit_utilization", "current_balance", "months_observed",
        "label_available",
    ),
    screened=(
        "age", "income", "employment_years", "credit_score", "debt_to_income", "loan_amount",
        "interest_rate", "credit_utilization", "num_open_accounts",
    ),
    near_duplicate=(
        "age", "income", "credit_score", "debt_to_income", "loan_amount", "interest_rate",
        "credit_utilization", "num_open_accounts",
    ),
    rules={"employment_years": "employment_years > age - 14"},
    income="income",
    amount="loan_amount",
    balance="current_balance",
    later_income="returned_value_12m",
    withheld=("employment_years", "interest_rate"),
)
