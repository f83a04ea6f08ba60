"""Query registry and the SQL fragments shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline import schema
from stayline.functions.numeric import round_to

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent statement over the same tables."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded_columns(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: round_to(F.col(n), digits) for n in names})


def rounded(expression: str, digits: int) -> str:
    """Half-up rounding that matches :func:`rounded_columns`."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,{digits + 4})), {digits}) AS DOUBLE)"


def titled(expression: str) -> str:
    """Title case after every non-letter."""
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({expression}), '[a-z]+|[^a-z]+'), "
        "lambda x: upper(x[1]) || x[2:]), '')"
    )


def stripped(expression: str) -> str:
    return f"regexp_replace({expression}, '^\\s+|\\s+$', '', 'g')"


def normalized(expression: str) -> str:
    trimmed = stripped(expression)
    unified = (
        f"CASE WHEN {trimmed} IN ('No internet service', 'No phone service') THEN 'No' ELSE {trimmed} END"
    )
    return f"CASE WHEN {expression} IS NOT NULL THEN {titled(unified)} END"


CHURN_RAW = """
SELECT u.* EXCLUDE (c_custkey) FROM (
  SELECT * FROM base UNION ALL SELECT * FROM base WHERE c_custkey % 50 = 0) u
"""

_ORDERS = """
SELECT o_custkey, COUNT(*) AS n_orders, MIN(o_orderdate) AS first_dt, MAX(o_orderdate) AS last_dt,
       CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders GROUP BY o_custkey
"""


def _addon(condition: str, name: str) -> str:
    return (
        f"CASE WHEN c_custkey % 5 = 0 THEN 'No internet service' WHEN {condition} THEN 'Yes' "
        f"ELSE 'No' END AS {name}"
    )


_BASE = f"""
SELECT c_custkey, c_name AS customerID,
  CASE WHEN c_custkey % 22 = 0 THEN '  female ' WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CAST(CASE WHEN c_custkey % 301 = 0 THEN 5 WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS INTEGER) AS SeniorCitizen,
  CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
  CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
  CAST(CASE WHEN c_custkey % 211 = 0 THEN -3
       ELSE (YEAR(last_dt) - YEAR(first_dt)) * 12 + MONTH(last_dt) - MONTH(first_dt) END AS INTEGER) AS tenure,
  CASE WHEN c_custkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS PhoneService,
  CASE WHEN c_custkey % 10 = 0 THEN 'No phone service' WHEN c_custkey % 10 < 5 THEN 'No' ELSE 'Yes' END AS MultipleLines,
  CASE WHEN c_custkey % 5 = 0 THEN 'No' WHEN c_custkey % 5 < 3 THEN 'DSL' ELSE 'Fiber optic' END AS InternetService,
  {_addon('c_custkey % 3 = 0', 'OnlineSecurity')},
  {_addon('c_custkey % 4 = 0', 'OnlineBackup')},
  {_addon('c_custkey % 7 < 3', 'DeviceProtection')},
  {_addon('c_custkey % 9 < 4', 'TechSupport')},
  {_addon('c_custkey % 11 < 5', 'StreamingTV')},
  {_addon('c_custkey % 13 < 6', 'StreamingMovies')},
  CASE WHEN c_custkey % 3 = 0 THEN 'Month-to-month' WHEN c_custkey % 3 = 1 THEN 'One year' ELSE 'Two year' END AS Contract,
  CASE WHEN c_custkey % 101 = 0 THEN NULL WHEN c_custkey % 8 < 5 THEN 'yes' ELSE 'No' END AS PaperlessBilling,
  CASE WHEN c_custkey % 4 = 0 THEN 'Electronic check' WHEN c_custkey % 4 = 1 THEN 'Mailed check'
       WHEN c_custkey % 4 = 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
  CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE FLOOR(CAST(cents AS DOUBLE) / n_orders / 1000) / 100 END AS MonthlyCharges,
  CASE WHEN c_custkey % 89 = 0 THEN ' ' ELSE CAST(CAST(FLOOR(CAST(cents AS DOUBLE) / 100000) AS BIGINT) AS VARCHAR) END AS TotalCharges,
  CASE WHEN last_dt < TIMESTAMP '2001-01-01 00:00:00' THEN 'Yes' ELSE 'No' END AS Churn
FROM customer LEFT JOIN spend ON o_custkey = c_custkey
"""

RAW_CTES = f"spend AS ({_ORDERS}), base AS ({_BASE}), churn_raw AS ({CHURN_RAW})"

RAW_NAMES = {
    "customerID": "customer_id",
    "gender": "gender",
    "SeniorCitizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "tenure": "tenure",
    "PhoneService": "phone_service",
    "MultipleLines": "multiple_lines",
    "InternetService": "internet_service",
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
    "Contract": "contract",
    "PaperlessBilling": "paperless_billing",
    "PaymentMethod": "payment_method",
    "MonthlyCharges": "monthly_charges",
    "TotalCharges": "total_charges",
    "Churn": "churn",
}
RAW_COLUMNS = list(RAW_NAMES)
NUMERIC_RAW = ("SeniorCitizen", "tenure", "MonthlyCharges")
RAW_TEXT = [c for c in RAW_COLUMNS if c not in NUMERIC_RAW]
CLEAN_NUMERIC = ("senior_citizen", "tenure", "monthly_charges", "total_charges")
CLEAN_TEXT = [c for c in RAW_NAMES.values() if c not in CLEAN_NUMERIC]

_RENAMED = ", ".join(f"{old} AS {new}" for old, new in RAW_NAMES.items())
_TYPED = ", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in CLEAN_NUMERIC else c for c in RAW_NAMES.values()
)
_NORMALIZED = ", ".join(
    f"{normalized(c)} AS {c}" if c in CLEAN_TEXT else c for c in RAW_NAMES.values()
)
_MEDIANS = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in CLEAN_NUMERIC)
_FILLED = ", ".join(
    f"COALESCE({c}, 'Unknown') AS {c}" if c in CLEAN_TEXT else f"COALESCE({c}, m_{c}) AS {c}"
    for c in RAW_NAMES.values()
)
_POSSIBLE = """* REPLACE (
  CASE WHEN tenure < 0 THEN NULL ELSE tenure END AS tenure,
  CASE WHEN monthly_charges < 0 THEN NULL ELSE monthly_charges END AS monthly_charges,
  CASE WHEN total_charges < 0 THEN NULL ELSE total_charges END AS total_charges,
  CASE WHEN senior_citizen NOT IN (0, 1) THEN NULL ELSE senior_citizen END AS senior_citizen)"""
OUTLIERS = ("tenure", "monthly_charges", "total_charges")


def bounds(columns, source: str) -> str:
    """SELECT of lo_/hi_ IQR bounds per column."""
    parts = []
    for c in columns:
        q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
        parts.append(f"{q1} - 1.5 * ({q3} - {q1}) AS lo_{c}, {q3} + 1.5 * ({q3} - {q1}) AS hi_{c}")
    return f"SELECT {', '.join(parts)} FROM {source}"


def capped(columns) -> str:
    """REPLACE list that caps columns to their lo_/hi_ bounds."""
    return ", ".join(
        f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END AS {c}"
        for c in columns
    )


SERVICES = list(schema.SERVICE_COLUMNS)
TOTAL_SERVICES = (
    "CAST(" + " + ".join(f"CASE WHEN lower({c}) = 'no' THEN 0 ELSE 1 END" for c in SERVICES) + " AS INTEGER)"
)

TYPED_CTES = (
    f"{RAW_CTES}, renamed AS (SELECT {_RENAMED} FROM churn_raw), typed AS (SELECT {_TYPED} FROM renamed)"
)
CLEAN_CTES = f"""{TYPED_CTES},
unique_rows AS (SELECT DISTINCT * FROM typed),
normal AS (SELECT {_NORMALIZED} FROM unique_rows),
medians AS (SELECT {_MEDIANS} FROM normal),
filled AS (SELECT {_FILLED} FROM normal CROSS JOIN medians),
possible AS (SELECT {_POSSIBLE} FROM filled),
limits AS ({bounds(OUTLIERS, 'possible')}),
cleaned AS (SELECT p.* REPLACE ({capped(OUTLIERS)}), {TOTAL_SERVICES} AS total_services
  FROM possible p CROSS JOIN limits)"""


def raw_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([RAW_CTES, *ctes]) + "\n" + body


def typed_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([TYPED_CTES, *ctes]) + "\n" + body


def clean_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([CLEAN_CTES, *ctes]) + "\n" + body


SCORED = """scored AS (
SELECT c_name AS customer_id,
  CAST((c_custkey * 37) % 100 AS DOUBLE) / 100 AS churn_probability_logistic_regression,
  CAST((c_custkey * 53 + 11) % 100 AS DOUBLE) / 100 AS churn_probability_random_forest,
  CAST((c_custkey * 71 + 29) % 100 AS DOUBLE) / 100 AS churn_probability_gradient_boosting,
  CAST((c_custkey * 71 + 29) % 100 AS DOUBLE) / 100 AS churn_probability,
  CAST(c_custkey % 4 AS INTEGER) AS segment
FROM customer)"""

RUNS = """runs AS (
SELECT p_partkey AS run_seq, p_brand AS model_name,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 100 END AS cv_score
FROM part)"""
