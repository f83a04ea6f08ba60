"""Queries of the text operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.llm.common import text_of
from stayline.llm.decontamination import WINDOW as ITEM_WINDOW, contamination
from stayline.llm.exact_dedup import exact_groups
from stayline.llm.fill_in_middle import digests
from stayline.llm.line_dedup import keep_bitmaps, with_kept_text
from stayline.llm.mixing import mixture
from stayline.llm.pieces import round_trips
from stayline.llm.registry import query, table
from stayline.llm.secret_scan import secret_spans
from stayline.llm.substring_dedup import WINDOW, without_repeated_windows

#: A line found in this many documents loses its lines everywhere.
LINE_DOCUMENTS = 10

_KEY = "translate(regexp_replace(u, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_line_dedup",
    f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS u,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS p
  FROM documents),
k AS (SELECT doc_id, u, p, {_KEY} AS key FROM l),
r AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= {LINE_DOCUMENTS}),
m AS (SELECT k.*, r.key IS NOT NULL AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(u, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = keep_bitmaps(docs, min_docs=LINE_DOCUMENTS, keep_first=False)
    kept = with_kept_text(docs, bitmaps, "n_lines", "n_dropped")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text_of().cast("binary"), 256).alias("kept_sha256"))


@query(
    "op3_exact_dedup",
    """
SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size,
       doc_id = MAX(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op8_substring_dedup",
    f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, p, array_to_string(w[p:p + {WINDOW - 1}], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM d)),
f AS (SELECT k, MIN(doc_id) AS first_doc FROM x GROUP BY k),
r AS (SELECT doc_id, p FROM x JOIN f USING (k) WHERE doc_id > first_doc),
g AS (SELECT DISTINCT doc_id, p + o AS i FROM r, range(0, {WINDOW}) AS t(o)),
m AS (SELECT doc_id, unnest(w) AS u, unnest(range(1, len(w) + 1)) AS i FROM d),
s AS (SELECT m.doc_id, COUNT(*) AS n_words, COUNT(g.i) AS n_removed,
             string_agg(u, ' ' ORDER BY m.i) FILTER (WHERE g.i IS NULL) AS kept
      FROM m LEFT JOIN g ON m.doc_id = g.doc_id AND m.i = g.i GROUP BY m.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
""",
)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_windows(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op9_pieces")
def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_pieces", F.sha2("ids", 256).alias("ids_sha256"), "round_trip"
    )


def _part(at: int) -> str:
    return f"CAST('0x' || substr(h, {at}, 8) AS BIGINT)"


@query(
    "op11_fill_in_middle",
    f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
u AS (SELECT *, {_part(1)} % (n + 1) AS c1, {_part(9)} % (n + 1) AS c2, {_part(17)} % 100 AS p, {_part(25)} % 100 AS s FROM d),
f AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR p >= 90 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
o AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o
""",
)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+')"


@query(
    "op12_decontamination",
    f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
i AS (SELECT item_id, unnest(range(1, greatest(1, len(w) - {ITEM_WINDOW - 1}) + 1)) AS p, w, least(len(w), {ITEM_WINDOW}) AS n
      FROM b WHERE len(w) > 0),
k AS (SELECT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS k FROM i),
l AS (SELECT DISTINCT n FROM k),
x AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, l),
m AS (SELECT r, x.n, p, item_id FROM (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS k FROM x) x JOIN k ON x.n = k.n AND x.k = k.k),
h AS (SELECT r, COUNT(DISTINCT p + o) AS n_hit FROM m, range(0, {ITEM_WINDOW}) AS t(o) WHERE o < m.n GROUP BY r),
e AS (SELECT r, COUNT(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN e USING (r)
""",
)
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
