"""Queries of the operators that score pages and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.llm.host_reputation import (
    DEVIATIONS,
    LEAST_RATE,
    RULES,
    STRENGTH,
    TWO_LABEL_SUFFIXES,
    judge_urls,
)
from stayline.llm.near_dedup import near_classes
from stayline.llm.registry import query, table
from stayline.llm.toxicity import toxicity_scores


def _shrunk_sql(name: str, keys: str) -> str:
    """CTEs that shrink groups ``name`` (keys, n, good, parent) towards their parents: ``name``_mean."""
    weakest, strongest = STRENGTH
    spread = "n * pow(good / n - parent, 2) / (parent * (1 - parent)) - 1"
    return f"""{name}_rho AS (SELECT CASE WHEN SUM(n - 1) > 0 THEN SUM({spread}) / SUM(n - 1) ELSE 0 END AS rho FROM {name} WHERE n > 0),
{name}_k AS (SELECT CASE WHEN coalesce(rho, 0) <= 0 THEN {strongest} ELSE least({strongest}, greatest({weakest}, 1 / rho - 1)) END AS k
  FROM {name}_rho),
{name}_mean AS (SELECT {keys}, n, k, (good + k * parent) / (n + k) AS mean FROM {name}, {name}_k)"""


def _rule_sql(then: str) -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r.host + r.path), r))
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    return "CASE " + " ".join(
        f"WHEN {fits.format(r.host, r.path)} THEN '{r.host + r.path if then == 'text' else r.action}'" for r in ordered
    ) + " END"


_SUFFIXES = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
_URL_FILTER = f"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
seen AS (SELECT host, COUNT(*) AS n, SUM(quality) AS good FROM parts JOIN labels ON page_id = doc_id
  WHERE quality IS NOT NULL GROUP BY host),
named AS (SELECT host, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':\\d*$', ''), '.') AS l
  FROM (SELECT DISTINCT host FROM parts)),
ends AS (SELECT host, l, CASE WHEN array_to_string(l[greatest(len(l) - 1, 1):], '.') IN ({_SUFFIXES}) THEN 2 ELSE 1 END AS z FROM named),
hosts AS (SELECT host, array_to_string(l[greatest(len(l) - z, 1):], '.') AS domain,
    array_to_string(l[greatest(len(l) - z + 1, 1):], '.') AS suffix,
    CAST(coalesce(n, 0) AS DOUBLE) AS n, CAST(coalesce(good, 0) AS DOUBLE) AS good FROM ends LEFT JOIN seen USING (host)),
total AS (SELECT (SUM(good) + 1) / (SUM(n) + 2) AS m FROM hosts),
s AS (SELECT suffix, SUM(n) AS n, SUM(good) AS good, m AS parent FROM hosts, total GROUP BY suffix, m),
{_shrunk_sql('s', 'suffix')},
d AS (SELECT h.domain, h.suffix, SUM(h.n) AS n, SUM(h.good) AS good, any_value(mean) AS parent
  FROM hosts h JOIN s_mean USING (suffix) GROUP BY h.domain, h.suffix),
{_shrunk_sql('d', 'domain, suffix')},
h AS (SELECT host, hosts.n, good, mean AS parent FROM hosts JOIN d_mean USING (domain, suffix)),
{_shrunk_sql('h', 'host')},
bounds AS (SELECT host, mean - {DEVIATIONS} * sqrt(mean * (1 - mean) / (n + k + 1)) AS bound FROM h_mean)
SELECT page_id, host, path, {_rule_sql('text')} AS rule,
       coalesce({_rule_sql('action')}, CASE WHEN bound >= {LEAST_RATE} THEN 'allow' ELSE 'block' END) AS verdict
FROM parts JOIN bounds USING (host)
"""


@query("op2_url_filter", _URL_FILTER)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "p_low_quality", "p_toxic", F.col("rejected").alias("toxic"))


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")
