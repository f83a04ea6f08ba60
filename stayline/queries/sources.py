"""Readers, writers and fingerprints exercised over derived tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from stayline import schema
from stayline.fixtures import churn_raw, scored, table
from stayline.operators import compare, scoring
from stayline.plans.cleaning import clean_customers, typed
from stayline.queries.registry import (
    CLEAN_NUMERIC,
    RAW_COLUMNS,
    RAW_NAMES,
    SCORED,
    clean_sql,
    query,
    raw_sql,
    rounded,
    rounded_columns,
    typed_sql,
)
from stayline.queries.scoring import COMPARED, comparison_sql
from stayline.session import scratch_path
from stayline.sources import fingerprint, inference, readers, writers


@query("raw_csv_scan", raw_sql("SELECT * FROM churn_raw"))
def raw_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    writer = churn_raw(spark, sf_dir).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_raw_csv(spark, path)


@query(
    "raw_csv_inferred",
    raw_sql(
        "SELECT * REPLACE (CAST(SeniorCitizen AS BIGINT) AS SeniorCitizen, CAST(tenure AS BIGINT) AS tenure) FROM churn_raw"
    ),
)
def raw_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    writer = churn_raw(spark, sf_dir).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return inference.read_inferred_csv(spark, path).rows


@query(
    "raw_csv_rejected",
    raw_sql(
        """SELECT customerID AS customer_id, reason, COUNT(*) AS lines FROM (
          SELECT customerID, CASE WHEN customerID LIKE '%07' OR customerID LIKE '%13' THEN 'fields'
            WHEN TotalCharges = ' ' THEN 'TotalCharges' ELSE 'none' END AS reason FROM churn_raw) r
        GROUP BY customerID, reason"""
    ),
)
def raw_csv_rejected(spark, sf_dir):
    """Every line of an extract with planted bad lines: one field too many (…07), eighteen too few (…13), blank totals."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS]
    whole, key = F.concat_ws(",", *fields), F.col("customerID")
    line = F.when(key.endswith("07"), F.concat(whole, F.lit(",extra")))
    line = line.when(key.endswith("13"), F.concat_ws(",", *fields[:3])).otherwise(whole)
    path = scratch_path(spark, "bad-lines")
    # One column under the whole header, with a separator that no line holds: lines are written as they are.
    writer = churn_raw(spark, sf_dir).select(line.alias(",".join(RAW_COLUMNS))).write
    writer = writer.option("header", True).option("sep", "\x01")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    extract = inference.read_inferred_csv(spark, path, tolerance=0.05)
    rejected = extract.rejected.select(
        F.col("fields.customerID").alias("customer_id"), F.array_join("reasons", ",").alias("reason")
    )
    fine = extract.rows.select(F.col("customerID").alias("customer_id"), F.lit("none").alias("reason"))
    return rejected.unionByName(fine).groupBy("customer_id", "reason").agg(F.count(F.lit(1)).alias("lines"))


_BATCH = ", ".join(c for c in RAW_NAMES.values() if c != "churn")


@query(
    "batch_scan",
    typed_sql(
        f"SELECT 'parquet' AS format, {_BATCH} FROM typed UNION ALL SELECT 'csv' AS format, {_BATCH} FROM typed"
    ),
)
def batch_scan(spark, sf_dir):
    batch = typed(churn_raw(spark, sf_dir)).drop("churn")
    parquet = scratch_path(spark, "batch") + ".parquet"
    csv = scratch_path(spark, "batch") + ".csv"
    batch.write.parquet(parquet)
    writer = batch.write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(csv)
    both = [
        readers.read_batch(spark, path, batch.schema).select(F.lit(kind).alias("format"), "*")
        for kind, path in (("parquet", parquet), ("csv", csv))
    ]
    return both[0].unionByName(both[1])


@query(
    "extraction_profile",
    raw_sql(
        " UNION ALL ".join(
            f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column",
            '{schema.RAW_SCHEMA[c].dataType.simpleString()}' AS type, COUNT({c}) AS non_null, COUNT(*) AS rows,
            CAST(21 AS INTEGER) AS columns FROM churn_raw"""
            for i, c in enumerate(RAW_COLUMNS, start=1)
        )
    ),
)
def extraction_profile(spark, sf_dir):
    return fingerprint.extraction_profile(churn_raw(spark, sf_dir))


def _fingerprint_sql(source: str, names) -> str:
    text = [f"CAST({c} AS VARCHAR)" for c in names]
    parts = " || ".join(f"COALESCE(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in text)
    return f"""SELECT *, md5(concat_ws('|', CAST(rows AS VARCHAR), CAST("xor" AS VARCHAR), CAST(total AS VARCHAR))) AS fingerprint
    FROM (SELECT COUNT(*) AS rows, COALESCE(bit_xor(h), 0) AS "xor",
      CAST(COALESCE(SUM(h % 1000000007), 0) AS BIGINT) AS total
      FROM (SELECT CAST('0x' || substr(md5({parts}), 1, 15) AS BIGINT) AS h FROM {source}) d) t"""


@query("dataset_fingerprint", raw_sql(_fingerprint_sql("churn_raw", RAW_COLUMNS)))
def dataset_fingerprint(spark, sf_dir):
    return fingerprint.dataset_fingerprint(churn_raw(spark, sf_dir))


_LINE = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


@query("dataset_fingerprint_lineitem", _fingerprint_sql("lineitem", _LINE))
def dataset_fingerprint_lineitem(spark, sf_dir):
    return fingerprint.dataset_fingerprint(table(spark, sf_dir, "lineitem").select(*_LINE))


_NOW = datetime(1998, 1, 1)
_SPAN = timedelta(days=365)


@query(
    "fingerprint_gate",
    """SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS fingerprint FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
      AND o_orderdate > TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 365 DAY)""",
)
def fingerprint_gate(spark, sf_dir):
    inputs = table(spark, sf_dir, "customer").select(
        "c_custkey", F.md5(F.col("c_custkey").cast("string").cast("binary")).alias("fingerprint")
    )
    manifest = table(spark, sf_dir, "orders").select(
        F.md5(F.col("o_custkey").cast("string").cast("binary")).alias("fingerprint"),
        F.concat(F.lit("cleaned-"), F.col("o_orderkey").cast("string")).alias("output_path"),
        F.col("o_orderdate").alias("created_at"),
    )
    return fingerprint.pending(inputs, manifest, _NOW, _SPAN)


@query("cleaned_sink_roundtrip", clean_sql(
    "SELECT " + ", ".join(
        f"{rounded(c, 4)} AS {c}" if c in CLEAN_NUMERIC else c for c in [*RAW_NAMES.values(), "total_services"]
    ) + " FROM cleaned"
))
def cleaned_sink_roundtrip(spark, sf_dir):
    cleaned = clean_customers(churn_raw(spark, sf_dir))
    path = writers.write_cleaned(cleaned, scratch_path(spark, "cleaned"))
    return rounded_columns(spark.read.schema(cleaned.schema).parquet(path), 4, *CLEAN_NUMERIC)


_DECIDED = """SELECT *, CAST(CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS churn_prediction,
CASE WHEN churn_probability >= 0.5 THEN 'Yes' ELSE 'No' END AS churn_label,
CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_group"""


def _weekly(spark, sf_dir):
    """The scored customers in two weekly batches, by customer segment."""
    rows = scoring.add_decision(scored(spark, sf_dir))
    return [
        ("20240101T090000", rows.where(F.col("segment") < 2)),
        ("20240108T090000", rows.where(F.col("segment") >= 1)),
    ]


@query(
    "predictions_latest",
    f"WITH {SCORED} {_DECIDED}, '20240108T090000' AS batch_id FROM scored WHERE segment >= 1",
)
def predictions_latest(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    for batch, rows in _weekly(spark, sf_dir):
        writers.append_batch(rows, path, batch)
    return writers.read_latest(spark, path, rows.schema)


@query(
    "comparison_latest",
    f"WITH {SCORED}, compared AS (WITH "
    + comparison_sql("(SELECT * FROM scored WHERE segment >= 1) s", "CAST(NULL AS VARCHAR)|CAST(NULL AS INTEGER)")
    + ") SELECT *, '20240108T090000' AS batch_id, TIMESTAMP '2024-01-08 09:00:00' AS comparison_timestamp FROM compared",
)
def comparison_latest(spark, sf_dir):
    path = scratch_path(spark, "comparison")
    for batch, rows in _weekly(spark, sf_dir):
        report = writers.with_comparison_lineage(
            rounded_columns(compare.model_comparison(rows), 6, *COMPARED),
            batch,
            datetime.strptime(batch, "%Y%m%dT%H%M%S"),
        )
        writers.append_batch(report, path, batch)
    return writers.read_latest(spark, path, report.schema)
