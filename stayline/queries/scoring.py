"""Scoring, comparison and champion queries over fixed scores and runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from stayline.fixtures import churn_raw, runs, scored, table
from stayline.functions import ordinal
from stayline.functions.numeric import round_to
from stayline.operators import champions, compare, quality, scoring, services
from stayline.plans.cleaning import typed
from stayline.queries.registry import RUNS, SCORED, query, rounded, rounded_columns, typed_sql
from stayline.session import scratch_path

AT = datetime(2024, 1, 1, 9, 0, 0)
BATCH = "20240101T090000"
PRIMARY_URI = "models:/attrition-primary@champion"
MODELS = ("logistic_regression", "random_forest", "gradient_boosting")
P = {m: f"churn_probability_{m}" for m in MODELS}


def scored_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SCORED, *ctes]) + "\n" + body


_RISK = "CASE WHEN {0} >= 0.7 THEN 'High' WHEN {0} >= 0.4 THEN 'Medium' ELSE 'Low' END"
_DECIDED = f"""decided AS (SELECT *, CAST(CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS churn_prediction,
CASE WHEN churn_probability >= 0.5 THEN 'Yes' ELSE 'No' END AS churn_label,
{_RISK.format('churn_probability')} AS risk_group FROM scored)"""


@query(
    "risk_groups",
    scored_sql(
        "SELECT customer_id, " + ", ".join(f"{_RISK.format(c)} AS risk_{m}" for m, c in P.items())
        + f", {_RISK.format('churn_probability')} AS risk_group FROM scored"
    ),
)
def risk_groups(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "customer_id",
        *[scoring.risk_group(F.col(c)).alias(f"risk_{m}") for m, c in P.items()],
        scoring.risk_group(F.col("churn_probability")).alias("risk_group"),
    )


@query("decisions", scored_sql("SELECT * FROM decided", _DECIDED))
def decisions(spark, sf_dir):
    return scoring.add_decision(scored(spark, sf_dir))


@query(
    "prediction_metadata",
    scored_sql(
        f"""SELECT *, TIMESTAMP '2024-01-01 09:00:00' AS prediction_timestamp, '{PRIMARY_URI}' AS model_uri,
        CAST(7 AS INTEGER) AS model_version, '{BATCH}' AS batch_id FROM scored"""
    ),
)
def prediction_metadata(spark, sf_dir):
    return scoring.add_metadata(scored(spark, sf_dir), PRIMARY_URI, scoring.batch_id(AT), AT, 7)


@query("batch_ids", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS batch_id FROM events")
def batch_ids(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", scoring.batch_id_column(F.col("ts")).alias("batch_id")
    )


@query(
    "probabilities_long",
    scored_sql(
        " UNION ALL ".join(
            f"SELECT customer_id, '{m}' AS model, {c} AS probability FROM scored" for m, c in P.items()
        )
    ),
)
def probabilities_long(spark, sf_dir):
    return scoring.probabilities_long(scored(spark, sf_dir))


@query(
    "model_uri_parts",
    r"""WITH uris AS (SELECT p_partkey AS id, CASE p_partkey % 3
      WHEN 0 THEN 'models:/' || p_brand || '@champion' WHEN 1 THEN 'models:/' || p_brand || '/' || CAST(p_size AS VARCHAR)
      ELSE 'runs:/' || p_brand END AS uri FROM part)
    SELECT id, uri, CASE WHEN id % 3 < 2 THEN regexp_extract(uri, '^models:/([^@/]+)', 1) END AS name,
      CASE WHEN id % 3 = 0 THEN regexp_extract(uri, '@(.+)$', 1) END AS alias,
      CASE WHEN id % 3 = 1 THEN regexp_extract(uri, '^models:/[^@/]+/(.+)$', 1) END AS version FROM uris""",
)
def model_uri_parts(spark, sf_dir):
    k = F.col("p_partkey")
    named = F.concat(F.lit("models:/"), "p_brand")
    uri = (
        F.when(k % 3 == 0, F.concat(named, F.lit("@champion")))
        .when(k % 3 == 1, F.concat(named, F.lit("/"), F.col("p_size").cast("string")))
        .otherwise(F.concat(F.lit("runs:/"), "p_brand"))
    )
    parts = table(spark, sf_dir, "part").select(k.alias("id"), uri.alias("uri"))
    return parts.withColumn("p", scoring.uri_parts(F.col("uri"))).select("id", "uri", "p.name", "p.alias", "p.version")


@query(
    "probability_spread",
    scored_sql(
        f"SELECT customer_id, {rounded('greatest({0}) - least({0})'.format(', '.join(P.values())), 6)} AS spread FROM scored"
    ),
)
def probability_spread(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "customer_id", round_to(scoring.probability_spread(list(P.values())), 6).alias("spread")
    )


@query("feature_projection", typed_sql("SELECT * EXCLUDE (customer_id, churn) FROM typed"))
def feature_projection(spark, sf_dir):
    return scoring.feature_projection(typed(churn_raw(spark, sf_dir)), strict=True)


_SOURCE = "source AS (SELECT * FROM unique_typed WHERE CAST(substr(customer_id, 10) AS BIGINT) % 17 <> 0)"
_UNIQUE = "unique_typed AS (SELECT DISTINCT * FROM typed)"


def _source(spark, sf_dir):
    rows = typed(churn_raw(spark, sf_dir)).distinct()
    return rows.where(F.substring("customer_id", 10, 9).cast("bigint") % 17 != 0)


@query(
    "enrich_predictions",
    typed_sql(
        """SELECT s.* EXCLUDE (customer_id, churn), p.customer_id, s.churn AS churn_actual, p.* EXCLUDE (customer_id)
        FROM scored p LEFT JOIN source s ON s.customer_id = p.customer_id""",
        SCORED,
        _UNIQUE,
        _SOURCE,
    ),
)
def enrich_predictions(spark, sf_dir):
    return scoring.enrich(scored(spark, sf_dir), _source(spark, sf_dir))


@query(
    "enriched_in_order",
    typed_sql(
        """SELECT s.* EXCLUDE (customer_id, churn), p.customer_id, s.churn AS churn_actual, p.* EXCLUDE (customer_id)
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY churn_probability DESC, customer_id) - 1 AS ordinal FROM scored) p
        LEFT JOIN source s ON s.customer_id = p.customer_id""",
        SCORED,
        _UNIQUE,
        _SOURCE,
    ),
)
def enriched_in_order(spark, sf_dir):
    """A batch in order of its scores, enriched, written and read back: the order of the batch."""
    batch, sink = scratch_path(spark, "ordered-batch"), scratch_path(spark, "ordered-sink")
    ranked = ordinal.with_ordinal(scored(spark, sf_dir), [F.col("churn_probability").desc(), "customer_id"])
    ordinal.write_in_order(ranked, batch)
    rows = ordinal.read_in_order(spark, batch)
    ordinal.write_in_order(scoring.enrich(rows, _source(spark, sf_dir)), sink)
    return ordinal.read_in_order(spark, sink)


@query(
    "unmatched_customers",
    typed_sql(
        """SELECT COUNT(*) AS unmatched FROM scored p
        WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.customer_id = p.customer_id AND s.churn IS NOT NULL)""",
        SCORED,
        _UNIQUE,
        _SOURCE,
    ),
)
def unmatched_customers(spark, sf_dir):
    return scoring.unmatched(scored(spark, sf_dir), _source(spark, sf_dir))


@query(
    "batch_validation",
    typed_sql(
        """SELECT * FROM (
        SELECT CAST(1 AS INTEGER) AS position, 'not_empty' AS "check", COUNT(*) > 0 AS passed, COUNT(*) AS observed FROM typed
        UNION ALL SELECT 2, 'id_present', TRUE, 0
        UNION ALL SELECT 3, 'features_present', TRUE, 0
        UNION ALL SELECT 4, 'ids_unique', COUNT(*) = COUNT(DISTINCT customer_id), COUNT(*) - COUNT(DISTINCT customer_id) FROM typed) c"""
    ),
)
def batch_validation(spark, sf_dir):
    return quality.batch_checks(services.total_services(typed(churn_raw(spark, sf_dir))))


@query(
    "customer_agreement",
    scored_sql(
        f"""SELECT customer_id, votes AS churn_votes, least({', '.join(P.values())}) AS min_probability,
        greatest({', '.join(P.values())}) AS max_probability,
        {rounded('greatest({0}) - least({0})'.format(', '.join(P.values())), 6)} AS probability_spread,
        CASE votes WHEN 3 THEN 'all_churn' WHEN 0 THEN 'all_no_churn' ELSE 'disagree' END AS agreement,
        votes * 2 > 3 AS consensus_churn
        FROM (SELECT *, {' + '.join(f'CAST({c} >= 0.5 AS INTEGER)' for c in P.values())} AS votes FROM scored) v"""
    ),
)
def customer_agreement(spark, sf_dir):
    return rounded_columns(compare.customer_agreement(scored(spark, sf_dir)), 6, "probability_spread")


_CHAMPIONS = """champions AS (
SELECT model_name, first(run_seq ORDER BY COALESCE(-cv_score, 'inf'::DOUBLE), run_seq) AS run_seq,
  MAX(cv_score) AS cv_score, COUNT(*) AS runs FROM runs GROUP BY model_name)"""


def comparison_sql(source: str, lineage: str) -> str:
    """Statement for the comparison of ``source``; ``lineage`` yields uri and version of a model."""
    votes = " + ".join(f"CAST({c} >= 0.5 AS INTEGER)" for c in P.values())
    spread = f"greatest({', '.join(P.values())}) - least({', '.join(P.values())})"
    parts = []
    for m, c in P.items():
        uri, version = lineage.format(model=m).split("|")
        parts.append(
            f"""SELECT '{m}' AS model, {uri} AS model_uri, {version} AS model_version,
            {rounded(f'AVG({c})', 6)} AS mean_churn_probability, {rounded(f'quantile_cont({c}, 0.5)', 6)} AS median_churn_probability,
            COUNT(CASE WHEN {c} >= 0.5 THEN 1 END) AS n_predicted_churn,
            {rounded(f'AVG(CASE WHEN {c} >= 0.5 THEN 1.0 ELSE 0.0 END)', 6)} AS churn_rate,
            COUNT(CASE WHEN {c} < 0.4 THEN 1 END) AS risk_low,
            COUNT(CASE WHEN {c} >= 0.4 AND {c} < 0.7 THEN 1 END) AS risk_medium,
            COUNT(CASE WHEN {c} >= 0.7 THEN 1 END) AS risk_high,
            {rounded(f'AVG(CASE WHEN ({c} >= 0.5) = (votes * 2 > 3) THEN 1.0 ELSE 0.0 END)', 6)} AS agreement_with_consensus,
            COUNT(*) AS batch_n_customers, COUNT(CASE WHEN votes = 3 THEN 1 END) AS batch_all_agree_churn,
            COUNT(CASE WHEN votes = 0 THEN 1 END) AS batch_all_agree_no_churn,
            COUNT(CASE WHEN votes NOT IN (0, 3) THEN 1 END) AS batch_disagree,
            {rounded('AVG(CASE WHEN votes IN (0, 3) THEN 1.0 ELSE 0.0 END)', 6)} AS batch_agreement_rate,
            {rounded('AVG(spread)', 6)} AS batch_mean_probability_spread FROM voted"""
        )
    return f"voted AS (SELECT *, {votes} AS votes, {spread} AS spread FROM {source})\n" + " UNION ALL ".join(parts)


COMPARED = (
    "mean_churn_probability", "median_churn_probability", "churn_rate", "agreement_with_consensus",
    "batch_agreement_rate", "batch_mean_probability_spread",
)


def lineage_table(spark, sf_dir):
    """Champion uri and version of each compared model, from the training history.

    Each model stands for one brand of the history, in brand order.
    """
    history = champions.champion_history(runs(spark, sf_dir))
    versions = history.groupBy("model_name").agg(F.max("version").cast("int").alias("model_version"))
    model = F.create_map(*[F.lit(x) for i, m in enumerate(MODELS) for x in (f"Brand#1{i + 1}", m)])
    return versions.select(
        model[F.col("model_name")].alias("model"),
        F.concat(F.lit("models:/"), "model_name", F.lit("@champion")).alias("model_uri"),
        "model_version",
    ).where(F.col("model").isNotNull())


_HISTORY = """history AS (
SELECT *, promoted_sum AS version FROM (
  SELECT *, CAST(SUM(CAST(promoted AS INTEGER)) OVER (PARTITION BY model_name ORDER BY run_seq) AS BIGINT) AS promoted_sum
  FROM (SELECT *, earlier = 0 OR (cv_score IS NOT NULL AND (best IS NULL OR cv_score > best)) AS promoted
    FROM (SELECT *, MAX(cv_score) OVER w AS best, COUNT(*) OVER w AS earlier FROM runs
      WINDOW w AS (PARTITION BY model_name ORDER BY run_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) a) b) c)"""

_LINEAGE = (
    "(SELECT ANY_VALUE(uri) FROM lineage WHERE model = '{model}')|"
    "(SELECT CAST(ANY_VALUE(version) AS INTEGER) FROM lineage WHERE model = '{model}')"
)
_LINEAGE_CTE = (
    "lineage AS (SELECT CASE model_name "
    + " ".join(f"WHEN 'Brand#1{i + 1}' THEN '{m}'" for i, m in enumerate(MODELS))
    + " END AS model, 'models:/' || model_name || '@champion' AS uri, MAX(version) AS version FROM history GROUP BY model_name)"
)


@query("model_comparison", scored_sql("", RUNS, _HISTORY, _LINEAGE_CTE, comparison_sql("scored", _LINEAGE)).rstrip())
def model_comparison(spark, sf_dir):
    compared = compare.model_comparison(scored(spark, sf_dir), lineage_table(spark, sf_dir))
    return rounded_columns(compared, 6, *COMPARED)


@query(
    "batch_summary",
    scored_sql(
        f"""SELECT metric, key, {rounded('value', 6)} AS value FROM (
        SELECT 'n_customers' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(COUNT(*) AS DOUBLE) AS value FROM decided
        UNION ALL SELECT 'n_predicted_churn', NULL, SUM(churn_prediction) FROM decided
        UNION ALL SELECT 'avg_churn_probability', NULL, AVG(churn_probability) FROM decided
        {''.join(f" UNION ALL SELECT 'risk_group', '{g}', COUNT(CASE WHEN risk_group = '{g}' THEN 1 END) FROM decided" for g in ('Low', 'Medium', 'High'))}
        {''.join(f" UNION ALL SELECT 'avg_churn_probability_per_model', '{m}', AVG({c}) FROM decided" for m, c in P.items())}
        UNION ALL SELECT 'segment', CAST(segment AS VARCHAR), COUNT(*) FROM decided GROUP BY segment) s""",
        _DECIDED,
    ),
)
def batch_summary(spark, sf_dir):
    return rounded_columns(compare.batch_summary(scoring.add_decision(scored(spark, sf_dir))), 6, "value")


@query(
    "champion_history",
    f"WITH {RUNS}, {_HISTORY} SELECT run_seq, model_name, cv_score, promoted, version FROM history",
)
def champion_history(spark, sf_dir):
    return champions.champion_history(runs(spark, sf_dir))


@query("champion_current", f"WITH {RUNS}, {_CHAMPIONS} SELECT * FROM champions")
def champion_current(spark, sf_dir):
    return champions.current_champions(runs(spark, sf_dir))


@query(
    "primary_selection",
    f"""WITH {RUNS}, weekly AS (SELECT *, CAST(FLOOR(run_seq / 25.0) AS BIGINT) AS week FROM runs
      WHERE model_name IN ('Brand#11', 'Brand#12', 'Brand#13') AND cv_score IS NOT NULL)
    SELECT week, model_name, run_seq, cv_score FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY week ORDER BY cv_score DESC, run_seq) AS place FROM weekly) w
    WHERE place = 1""",
)
def primary_selection(spark, sf_dir):
    weekly = runs(spark, sf_dir).withColumn("week", F.floor(F.col("run_seq") / 25))
    return champions.best_run(weekly, ("Brand#11", "Brand#12", "Brand#13"), ["week"])


@query(
    "run_metrics_long",
    f"""WITH {RUNS}, wide AS (SELECT run_seq, model_name, cv_score, p_retailprice / 10000 AS accuracy,
      CAST(p_size AS DOUBLE) AS true_positives FROM runs JOIN part ON p_partkey = run_seq)
    SELECT run_seq, model_name, 'cv_score' AS metric, cv_score AS value FROM wide WHERE cv_score IS NOT NULL
    UNION ALL SELECT run_seq, model_name, 'accuracy', accuracy FROM wide
    UNION ALL SELECT run_seq, model_name, 'true_positives', true_positives FROM wide""",
)
def run_metrics_long(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("run_seq"),
        (F.col("p_retailprice") / 10000).alias("accuracy"),
        F.col("p_size").alias("true_positives"),
        F.col("p_type").alias("note"),
        F.array(F.array("p_size")).alias("confusion_matrix"),
    )
    return champions.metrics_long(runs(spark, sf_dir).join(parts, "run_seq"), ["run_seq", "model_name"])
