"""Cleaning operators one by one, and the whole cleaning job."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline import schema
from stayline.fixtures import churn_raw, table
from stayline.functions import text
from stayline.operators import clean, columns, encode, quality, services
from stayline.plans.cleaning import clean_customers, clean_with_log, typed
from stayline.queries.registry import (
    CLEAN_NUMERIC,
    CLEAN_TEXT,
    OUTLIERS,
    RAW_NAMES,
    RAW_TEXT,
    SERVICES,
    TOTAL_SERVICES,
    bounds,
    capped,
    clean_sql,
    normalized,
    query,
    raw_sql,
    rounded,
    rounded_columns,
    titled,
    typed_sql,
)

CHARGES = ("monthly_charges", "total_charges")


def _typed(spark, sf_dir):
    return typed(churn_raw(spark, sf_dir))


def _snake_sql(c: str) -> str:
    for pattern, replacement in text.SNAKE_STEPS:
        c = f"regexp_replace({c}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return f"trim(lower({c}), '_')"


@query(
    "snake_case_values",
    f"""SELECT p_partkey AS id, {_snake_sql('p_name')} AS name, {_snake_sql('p_type')} AS kind,
    {_snake_sql("p_brand || ' HTTPServer-ID ' || p_name")} AS mixed FROM part""",
)
def snake_case_values(spark, sf_dir):
    mixed = F.concat("p_brand", F.lit(" HTTPServer-ID "), "p_name")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        text.snake_case_column(F.col("p_name")).alias("name"),
        text.snake_case_column(F.col("p_type")).alias("kind"),
        text.snake_case_column(mixed).alias("mixed"),
    )


@query("snake_case_columns", typed_sql("SELECT * FROM renamed"))
def snake_case_columns(spark, sf_dir):
    return clean.standardize_columns(churn_raw(spark, sf_dir))


@query("numeric_coerce", typed_sql("SELECT * FROM typed"))
def numeric_coerce(spark, sf_dir):
    return _typed(spark, sf_dir)


_DOMAIN = " UNION ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value FROM typed WHERE {c} IS NOT NULL" for c in schema.DOMAIN_COLUMNS
)


@query(
    "category_domain",
    typed_sql(
        """SELECT "column", value, CAST(ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY value) AS INTEGER) AS ordinal
        FROM domain""",
        f"domain AS ({_DOMAIN})",
    ),
)
def category_domain(spark, sf_dir):
    return encode.category_domain(_typed(spark, sf_dir))


@query(
    "normalize_categories",
    typed_sql(
        "SELECT " + ", ".join(f"{normalized(c)} AS {c}" if c in CLEAN_TEXT else c for c in RAW_NAMES.values())
        + " FROM typed"
    ),
)
def normalize_categories(spark, sf_dir):
    return clean.normalize_text(_typed(spark, sf_dir))


_SIDES = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", value, MAX(old) AS old, MAX(new) AS new FROM (
      SELECT {c} AS value, 1 AS old, 0 AS new FROM churn_raw UNION ALL
      SELECT {normalized(c)}, 0, 1 FROM churn_raw) s GROUP BY value"""
    for c in RAW_TEXT
)


@query(
    "normalization_changes",
    raw_sql(
        'SELECT "column", bool_or(old = 0 OR new = 0) AS changed FROM sides GROUP BY "column"',
        f"sides AS ({_SIDES})",
    ),
)
def normalization_changes(spark, sf_dir):
    return clean.normalization_changes(churn_raw(spark, sf_dir))


@query(
    "total_services",
    typed_sql(f"SELECT customer_id, {', '.join(SERVICES)}, {TOTAL_SERVICES} AS total_services FROM typed"),
)
def total_services(spark, sf_dir):
    counted = services.total_services(_typed(spark, sf_dir))
    return counted.select("customer_id", *SERVICES, "total_services")


@query(
    "null_impossible",
    typed_sql(
        """SELECT * REPLACE (CASE WHEN tenure < 0 THEN NULL ELSE tenure END AS tenure,
        CASE WHEN senior_citizen NOT IN (0, 1) THEN NULL ELSE senior_citizen END AS senior_citizen) FROM typed"""
    ),
)
def null_impossible(spark, sf_dir):
    return clean.null_impossible(_typed(spark, sf_dir))


@query(
    "impossible_counts",
    typed_sql(
        """SELECT *, before + invalid_replaced + below_min + above_max AS after FROM (
        SELECT 'tenure' AS "column", COUNT(*) - COUNT(tenure) AS before, CAST(0 AS BIGINT) AS invalid_replaced,
          COUNT(CASE WHEN tenure < 0 THEN 1 END) AS below_min, CAST(0 AS BIGINT) AS above_max FROM typed
        UNION ALL
        SELECT 'senior_citizen', COUNT(*) - COUNT(senior_citizen),
          COUNT(CASE WHEN senior_citizen NOT IN (0, 1) THEN 1 END), 0, 0 FROM typed) t
        WHERE invalid_replaced + below_min > 0"""
    ),
)
def impossible_counts(spark, sf_dir):
    return clean.impossible_counts(_typed(spark, sf_dir))


_MISSING = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in RAW_NAMES.values())


@query("drop_sparse_rows", typed_sql(f"SELECT * FROM typed WHERE NOT ({_MISSING}) > 0.04 * 21"))
def drop_sparse_rows(spark, sf_dir):
    return clean.drop_sparse_rows(_typed(spark, sf_dir), 0.04)


def _fill_sql(kind: str, where: str = "") -> str:
    def statistic(c: str) -> str:
        return f"quantile_cont({c}, 0.5)" if kind == "median" else f"AVG({c})"

    fills = ", ".join(f"{statistic(c)} AS f_{c}" for c in CLEAN_NUMERIC)
    filled = ", ".join(
        f"COALESCE({c}, 'Unknown') AS {c}" if c in CLEAN_TEXT
        else f"{rounded(f'COALESCE({c}, f_{c})', 4)} AS {c}"
        for c in RAW_NAMES.values()
    )
    return typed_sql(
        f"SELECT {filled} FROM kept CROSS JOIN fills",
        f"kept AS (SELECT * FROM typed {where})",
        f"fills AS (SELECT {fills} FROM kept)",
    )


@query("fill_missing_median", _fill_sql("median"))
def fill_missing_median(spark, sf_dir):
    return rounded_columns(clean.fill_missing(_typed(spark, sf_dir)), 4, *CLEAN_NUMERIC)


@query("fill_missing_mean", _fill_sql("mean", f"WHERE NOT ({_MISSING}) > 0.04 * 21"))
def fill_missing_mean(spark, sf_dir):
    filled = clean.fill_missing(_typed(spark, sf_dir), strategy="mean", drop_threshold=0.04)
    return rounded_columns(filled, 4, *CLEAN_NUMERIC)


@query(
    "iqr_winsorize",
    typed_sql(
        f"SELECT t.customer_id, {', '.join(f'{rounded(c, 4)} AS {c}' for c in OUTLIERS)} FROM "
        f"(SELECT t.* REPLACE ({capped(OUTLIERS)}) FROM typed t CROSS JOIN limits) t",
        f"limits AS ({bounds(OUTLIERS, 'typed')})",
    ),
)
def iqr_winsorize(spark, sf_dir):
    capped_rows = clean.winsorize_iqr(_typed(spark, sf_dir).select("customer_id", *OUTLIERS))
    return rounded_columns(capped_rows, 4, *OUTLIERS)


@query(
    "iqr_report",
    typed_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {rounded(f'lo_{c}', 4)} AS lower_bound, {rounded(f'hi_{c}', 4)} AS upper_bound,
            COUNT(CASE WHEN {c} < lo_{c} THEN 1 END) AS lower_capped, COUNT(CASE WHEN {c} > hi_{c} THEN 1 END) AS upper_capped
            FROM typed CROSS JOIN limits GROUP BY lo_{c}, hi_{c}
            HAVING COUNT(CASE WHEN {c} < lo_{c} OR {c} > hi_{c} THEN 1 END) > 0"""
            for c in OUTLIERS
        ),
        f"limits AS ({bounds(OUTLIERS, 'typed')})",
    ),
)
def iqr_report(spark, sf_dir):
    return rounded_columns(clean.iqr_report(_typed(spark, sf_dir)), 4, "lower_bound", "upper_bound")


@query(
    "iqr_winsorize_lineitem",
    f"""WITH q AS (SELECT l_returnflag AS f, quantile_cont(l_extendedprice, 0.25) AS q1,
      quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag),
    b AS (SELECT f, q1 - 1.5 * (q3 - q1) AS lo_l_extendedprice, q3 + 1.5 * (q3 - q1) AS hi_l_extendedprice FROM q)
    SELECT l_orderkey, l_linenumber, l_returnflag, {rounded('l_extendedprice', 4)} AS l_extendedprice FROM (
      SELECT l.* REPLACE ({capped(['l_extendedprice'])}) FROM lineitem l JOIN b ON f = l_returnflag) c""",
)
def iqr_winsorize_lineitem(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    return rounded_columns(clean.winsorize_iqr(lines, ["l_extendedprice"], ["l_returnflag"]), 4, "l_extendedprice")


@query("dedup_full", raw_sql("SELECT DISTINCT * FROM churn_raw"))
def dedup_full(spark, sf_dir):
    return clean.remove_duplicates(churn_raw(spark, sf_dir))


@query(
    "dedup_info",
    raw_sql(
        """SELECT SUM(1)::BIGINT AS initial_rows, CAST(SUM(1) - d.n AS BIGINT) AS duplicates_removed,
        d.n AS final_rows, CAST(NULL AS VARCHAR) AS subset_columns
        FROM churn_raw CROSS JOIN (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM churn_raw) x) d GROUP BY d.n"""
    ),
)
def dedup_info(spark, sf_dir):
    return clean.duplicate_info(churn_raw(spark, sf_dir))


@query(
    "dedup_subset_first",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS place FROM events) e
    WHERE place = 1""",
)
def dedup_subset_first(spark, sf_dir):
    return clean.remove_duplicates(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id")


@query("cleaned_customers", clean_sql(
    "SELECT " + ", ".join(
        f"{rounded(c, 4)} AS {c}" if c in CLEAN_NUMERIC else c for c in [*RAW_NAMES.values(), "total_services"]
    ) + " FROM cleaned"
))
def cleaned_customers(spark, sf_dir):
    return rounded_columns(clean_customers(churn_raw(spark, sf_dir)), 4, *CLEAN_NUMERIC)


# -- encoding ----------------------------------------------------------------

_CODES = {
    "internet_service": ["Dsl", "Fiber Optic", "No"],
    "contract": ["Month-To-Month", "One Year", "Two Year"],
    "paperless_billing": ["No", "Unknown", "Yes"],
    "payment_method": [
        "Bank Transfer (Automatic)", "Credit Card (Automatic)", "Electronic Check", "Mailed Check",
    ],
}
_BINARY = {
    "gender": "CASE {0} WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END",
    **{
        c: "CASE {0} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END"
        for c in schema.DOMAIN_COLUMNS
        if c != "gender" and c not in _CODES
    },
}


@query("binary_flags", clean_sql(
    "SELECT customer_id, " + ", ".join(
        f"CAST({e.format(c)} AS INTEGER) AS {c}_flag" for c, e in _BINARY.items()
    ) + " FROM cleaned"
))
def binary_flags(spark, sf_dir):
    flagged = encode.binary_flags(clean_customers(churn_raw(spark, sf_dir)))
    return flagged.select("customer_id", *[c for c in flagged.columns if c.endswith("_flag")])


def _code_expression(c: str) -> str:
    cases = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(_CODES[c], start=1))
    return f"CAST(CASE {c} {cases} END AS INTEGER) AS {c}_encoded"


@query("multiclass_codes", clean_sql(
    f"SELECT customer_id, {', '.join(_code_expression(c) for c in _CODES)} FROM cleaned"
))
def multiclass_codes(spark, sf_dir):
    coded = encode.multiclass_codes(clean_customers(churn_raw(spark, sf_dir)))
    return coded.select("customer_id", *[c for c in coded.columns if c.endswith("_encoded")])


def _distinct_sql(suffix: str, low: int, high: int, code: str) -> str:
    values = " UNION ".join(
        f"SELECT '{c}' AS c, {c} AS value FROM cleaned WHERE {c} IS NOT NULL"
        for c in CLEAN_TEXT if c != "customer_id"
    )
    return clean_sql(
        f"""SELECT c || '{suffix}' AS encoded_column, c AS source_column, value, CAST({code} AS INTEGER) AS code
        FROM (SELECT *, COUNT(*) OVER (PARTITION BY c) AS k,
          ROW_NUMBER() OVER (PARTITION BY c ORDER BY value) AS place FROM vals) v WHERE k BETWEEN {low} AND {high}""",
        f"vals AS ({values})",
    )


@query("binary_flag_mappings", _distinct_sql(
    "_flag", 2, 2, "CASE value WHEN 'Yes' THEN 1 WHEN 'Male' THEN 1 ELSE 0 END"
))
def binary_flag_mappings(spark, sf_dir):
    cleaned = clean_customers(churn_raw(spark, sf_dir))
    return encode.mapping_table(cleaned, encode.binary_mappings(cleaned), "_flag")


@query("multiclass_mappings", _distinct_sql("_encoded", 3, 10, "place"))
def multiclass_mappings(spark, sf_dir):
    cleaned = clean_customers(churn_raw(spark, sf_dir))
    return encode.mapping_table(cleaned, encode.multiclass_mappings(cleaned), "_encoded")


@query(
    "target_encode",
    typed_sql("SELECT customer_id, CAST(CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS label FROM typed"),
)
def target_encode(spark, sf_dir):
    return _typed(spark, sf_dir).select("customer_id", encode.target_code(F.col("churn")).alias("label"))


# -- validation of the cleaned table and of the dirty one ----------------------


def _validation_ctes(source: str, names) -> list[str]:
    nulls = " UNION ALL ".join(
        f"SELECT 'missing_values' AS \"check\", '{c}' AS \"column\", 'issue' AS severity, "
        f"CAST(COUNT(*) - COUNT({c}) AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS expected FROM {source}"
        for c in names
    )
    ranges = []
    for c, (low, high) in schema.NUMERIC_RANGES.items():
        if c in names:
            ranges.append(f"SELECT 'below_minimum', '{c}', 'issue', CAST(MIN({c}) AS DOUBLE), {low} FROM {source} HAVING MIN({c}) < {low}")
            ranges.append(f"SELECT 'above_maximum', '{c}', 'warning', CAST(MAX({c}) AS DOUBLE), {high} FROM {source} HAVING MAX({c}) > {high}")
    odd = [
        f"SELECT 'unexpected_values', '{c}', 'warning', CAST(COUNT(DISTINCT {titled(c)}) AS DOUBLE), NULL FROM {source} "
        f"WHERE {titled(c)} NOT IN ({', '.join(repr(v) for v in values)}) HAVING COUNT(*) > 0"
        for c, values in schema.EXPECTED_VALUES.items()
    ]
    repeats = f"""SELECT 'duplicate_rows', NULL, 'warning', CAST(a.n - b.n AS DOUBLE), NULL
      FROM (SELECT COUNT(*) AS n FROM {source}) a CROSS JOIN
      (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM {source}) x) b WHERE a.n > b.n"""
    ids = f"""SELECT 'id_not_unique', 'customer_id', 'issue', CAST(COUNT(DISTINCT customer_id) AS DOUBLE), COUNT(*)
      FROM {source} HAVING COUNT(DISTINCT customer_id) <> COUNT(*)"""
    return [
        f"missing AS ({nulls})",
        "findings AS (SELECT * FROM missing WHERE observed > 0 UNION ALL "
        + " UNION ALL ".join([*ranges, *odd, repeats, ids])
        + ")",
    ]


def _finding_rows() -> str:
    return (
        'SELECT "check", "column", severity, ' + rounded("observed", 4) + " AS observed, expected, "
        "CAST(NULL AS VARCHAR) AS detail FROM findings"
    )


def _summary_rows(source: str, width: int) -> str:
    return f"""SELECT COUNT(CASE WHEN severity = 'issue' THEN 1 END) = 0 AS is_valid,
    COUNT(CASE WHEN severity = 'issue' THEN 1 END) AS issues,
    COUNT(CASE WHEN severity = 'warning' THEN 1 END) AS warnings,
    (SELECT COUNT(*) FROM {source}) AS total_rows, CAST({width} AS BIGINT) AS total_columns,
    COUNT(CASE WHEN "check" = 'missing_values' THEN 1 END) AS missing_value_columns,
    CAST(COALESCE(MAX(CASE WHEN "check" = 'duplicate_rows' THEN observed END), 0) AS BIGINT) AS duplicate_rows
    FROM findings"""


_ALL = [*RAW_NAMES.values(), "total_services"]


@query("validation_report", clean_sql(_finding_rows(), *_validation_ctes("cleaned", _ALL)))
def validation_report(spark, sf_dir):
    cleaned = clean_customers(churn_raw(spark, sf_dir))
    return rounded_columns(quality.validation_report(cleaned), 4, "observed")


@query("validation_report_dirty", typed_sql(_finding_rows(), *_validation_ctes("typed", list(RAW_NAMES.values()))))
def validation_report_dirty(spark, sf_dir):
    return rounded_columns(quality.validation_report(_typed(spark, sf_dir)), 4, "observed")


@query("validation_summary", clean_sql(_summary_rows("cleaned", 22), *_validation_ctes("cleaned", _ALL)))
def validation_summary(spark, sf_dir):
    return quality.validation_summary(clean_customers(churn_raw(spark, sf_dir)))


def _entries(step: str, source: str, metrics: dict[str, str], column: str = "NULL") -> str:
    return " UNION ALL ".join(
        f"SELECT '{step}' AS step, {column} AS \"column\", '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM {source}"
        for m, e in metrics.items()
    )


_LOG_PARTS = [
    _entries("initial_shape", "churn_raw", {"rows": "COUNT(*)", "columns": "21"}).replace(
        "CAST(21 AS DOUBLE) AS value FROM churn_raw", "CAST(21 AS DOUBLE) AS value"
    ),
    _entries(
        "remove_duplicates",
        "(SELECT (SELECT COUNT(*) FROM churn_raw) AS a, (SELECT COUNT(*) FROM unique_rows) AS b) d",
        {"initial_rows": "a", "duplicates_removed": "a - b", "final_rows": "b"},
    ),
    *[
        _entries("impossible_values", f"(SELECT * FROM ({inner}) i WHERE bad > 0) j", metrics, f"'{c}'")
        for c, inner, metrics in [
            (
                "tenure",
                "SELECT COUNT(*) - COUNT(tenure) AS before, COUNT(CASE WHEN tenure < 0 THEN 1 END) AS bad FROM filled",
                {"before": "before", "invalid_replaced": "0", "below_min": "bad", "above_max": "0", "after": "before + bad"},
            ),
            (
                "senior_citizen",
                "SELECT COUNT(*) - COUNT(senior_citizen) AS before, "
                "COUNT(CASE WHEN senior_citizen NOT IN (0, 1) THEN 1 END) AS bad FROM filled",
                {"before": "before", "invalid_replaced": "bad", "below_min": "0", "above_max": "0", "after": "before + bad"},
            ),
        ]
    ],
    *[
        _entries(
            "outliers_capped",
            f"(SELECT lo_{c} AS lo, hi_{c} AS hi, COUNT(CASE WHEN {c} < lo_{c} THEN 1 END) AS l, "
            f"COUNT(CASE WHEN {c} > hi_{c} THEN 1 END) AS h FROM possible CROSS JOIN limits GROUP BY 1, 2) o WHERE l + h > 0",
            {"lower_bound": "lo", "upper_bound": "hi", "lower_capped": "l", "upper_capped": "h"},
            f"'{c}'",
        )
        for c in OUTLIERS
    ],
    _entries(
        "validation",
        "summary",
        {m: m if m != "is_valid" else "CAST(is_valid AS INTEGER)" for m in (
            "is_valid", "issues", "warnings", "missing_value_columns", "duplicate_rows")},
    ),
    _entries("final_shape", "(SELECT COUNT(*) AS n FROM cleaned) f", {"rows": "n", "columns": "22"}),
    *[
        f"SELECT 'final_columns', '{c}', 'position', CAST({i} AS DOUBLE)"
        for i, c in enumerate([*RAW_NAMES.values(), "total_services"], start=1)
    ],
]


@query(
    "transformation_log",
    clean_sql(
        f"""SELECT step, "column", metric, {rounded('value', 4)} AS value FROM ({' UNION ALL '.join(_LOG_PARTS)}) l""",
        *_validation_ctes("cleaned", _ALL),
        f"summary AS ({_summary_rows('cleaned', 22)})",
    ),
)
def transformation_log(spark, sf_dir):
    return rounded_columns(clean_with_log(churn_raw(spark, sf_dir)).log, 4, "value")


@query(
    "unexpected_values",
    typed_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {titled(c)} AS value, COUNT(*) AS n FROM typed "
            f"WHERE {titled(c)} NOT IN ({', '.join(repr(v) for v in values)}) GROUP BY 2"
            for c, values in schema.EXPECTED_VALUES.items()
        )
    ),
)
def unexpected_values(spark, sf_dir):
    return quality.unexpected_values(_typed(spark, sf_dir))


@query(
    "null_counts_lineitem",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls FROM lineitem"
        for c in (
            "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
            "l_returnflag l_linestatus l_shipdate"
        ).split()
    ),
)
def null_counts_lineitem(spark, sf_dir):
    return columns.null_counts(table(spark, sf_dir, "lineitem"))
