"""Splits, features, metrics, clusters and the fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline import schema
from stayline.fixtures import churn_raw, scored, table
from stayline.operators import clusters, encode, features, metrics, services, split
from stayline.plans.cleaning import clean_customers, typed
from stayline.queries.registry import (
    SCORED,
    TOTAL_SERVICES,
    clean_sql,
    query,
    raw_sql,
    rounded,
    rounded_columns,
    typed_sql,
)


# -- splits --------------------------------------------------------------------

_KEYS = "keys AS (SELECT DISTINCT customerID AS customer_id, Churn AS churn FROM churn_raw)"


def _keys(spark, sf_dir):
    raw = churn_raw(spark, sf_dir)
    return raw.select(F.col("customerID").alias("customer_id"), F.col("Churn").alias("churn")).distinct()


def _split_sql(source: str, key: str, target: str) -> str:
    return f"""SELECT {key}, {target}, ROW_NUMBER() OVER (PARTITION BY {target}
      ORDER BY md5(concat(CAST({key} AS VARCHAR), '|42')), {key})
      <= CEIL(0.2 * COUNT(*) OVER (PARTITION BY {target})) AS is_test FROM {source}"""


@query("stratified_split", raw_sql(_split_sql("keys", "customer_id", "churn"), _KEYS))
def stratified_split(spark, sf_dir):
    return split.stratified_split(_keys(spark, sf_dir))


@query("stratified_split_orders", _split_sql("orders", "o_orderkey", "o_orderstatus"))
def stratified_split_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(orders, "o_orderkey", "o_orderstatus")


def _fold_sql(source: str, key: str, target: str | None) -> str:
    partition = f"PARTITION BY {target} " if target else ""
    columns = f"{key}, {target}" if target else key
    return f"""SELECT {columns}, CAST((ROW_NUMBER() OVER ({partition}
      ORDER BY md5(concat(CAST({key} AS VARCHAR), '|42')), {key}) - 1) % 5 AS INTEGER) AS fold FROM {source}"""


@query("kfold_assignment", raw_sql(_fold_sql("keys", "customer_id", "churn"), _KEYS))
def kfold_assignment(spark, sf_dir):
    return split.kfold(_keys(spark, sf_dir))


@query("kfold_assignment_orders", _fold_sql("orders", "o_orderkey", "o_orderstatus"))
def kfold_assignment_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.kfold(orders, "o_orderkey", "o_orderstatus")


@query("kfold_plain", raw_sql(_fold_sql("keys", "customer_id", None), _KEYS.replace(", Churn AS churn", "")))
def kfold_plain(spark, sf_dir):
    return split.kfold(_keys(spark, sf_dir).select("customer_id"), target=None)


HELD = f"held AS ({_split_sql('cleaned', 'customer_id', 'churn')})"


@query(
    "holdout_batch",
    clean_sql(
        f"""SELECT c.* EXCLUDE (churn) REPLACE ({rounded('c.monthly_charges', 4)} AS monthly_charges,
        {rounded('c.total_charges', 4)} AS total_charges, {rounded('c.tenure', 4)} AS tenure)
        FROM cleaned c WHERE customer_id IN (SELECT customer_id FROM held WHERE is_test)""",
        HELD,
    ),
)
def holdout_batch(spark, sf_dir):
    batch = split.holdout_batch(clean_customers(churn_raw(spark, sf_dir)))
    return rounded_columns(batch, 4, "monthly_charges", "total_charges", "tenure")


# -- features ------------------------------------------------------------------


_CATEGORIES = list(schema.CATEGORICAL_FEATURES)


@query(
    "one_hot_columns",
    typed_sql(
        " UNION ALL ".join(
            f"SELECT customer_id, '{c}=' || COALESCE(CAST({c} AS VARCHAR), 'nan') AS feature, CAST(1 AS INTEGER) AS value FROM unique_typed"
            for c in _CATEGORIES
        ),
        "unique_typed AS (SELECT DISTINCT * FROM typed)",
    ),
)
def one_hot_columns(spark, sf_dir):
    return features.one_hot_long(typed(churn_raw(spark, sf_dir)).distinct(), "customer_id", _CATEGORIES)


def _scale_sql(source: str, key: str, names, train: str = "") -> str:
    statistics = ", ".join(f"AVG({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in names)
    scaled = ", ".join(
        rounded(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", 6) + f" AS {c}" for c in names
    )
    return f"SELECT {key}, {scaled} FROM {source} CROSS JOIN (SELECT {statistics} FROM {source} {train}) s"


_SCALED = list(schema.NUMERIC_FEATURES)


@query(
    "standard_scale",
    typed_sql(
        _scale_sql("served", "customer_id", _SCALED),
        f"served AS (SELECT *, {TOTAL_SERVICES} AS total_services FROM typed)",
    ),
)
def standard_scale(spark, sf_dir):
    rows = services.total_services(typed(churn_raw(spark, sf_dir))).select("customer_id", *_SCALED)
    return rounded_columns(features.standard_scale(rows, _SCALED), 6, *_SCALED)


_LINE = ["l_quantity", "l_extendedprice", "l_discount"]


@query("standard_scale_lineitem", _scale_sql("lineitem", "l_orderkey, l_linenumber", _LINE))
def standard_scale_lineitem(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_LINE)
    return rounded_columns(features.standard_scale(rows, _LINE), 6, *_LINE)


@query(
    "standard_scale_train_test",
    clean_sql(
        _scale_sql("joined", "customer_id, is_test", _SCALED, "WHERE NOT is_test"),
        HELD,
        "joined AS (SELECT c.*, h.is_test FROM cleaned c JOIN held h ON h.customer_id = c.customer_id)",
    ),
)
def standard_scale_train_test(spark, sf_dir):
    marked = split.stratified_split(clean_customers(churn_raw(spark, sf_dir)))
    rows = marked.select("customer_id", "is_test", *_SCALED)
    statistics = features.scale_statistics(rows.where(~F.col("is_test")), _SCALED)
    return rounded_columns(features.standard_scale(rows, _SCALED, statistics), 6, *_SCALED)


# -- metrics -------------------------------------------------------------------


def _labelled(spark, sf_dir):
    keys = _keys(spark, sf_dir).withColumn("label", encode.target_code(F.col("churn")))
    return scored(spark, sf_dir).join(keys, "customer_id")


_LABELLED = f"""{_KEYS}, labelled AS (SELECT s.*, CASE churn WHEN 'Yes' THEN 1 ELSE 0 END AS label
FROM scored s JOIN keys k ON k.customer_id = s.customer_id)"""


def _confusion_sql(label: str, prediction: str, source: str) -> str:
    return f"""SELECT true_negatives, false_positives, false_negatives, true_positives,
      {rounded('(tp + tn) / (tn + fp + fn + tp)', 6)} AS accuracy, {rounded('p', 6)} AS precision, {rounded('r', 6)} AS recall,
      {rounded('CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END', 6)} AS f1_score
    FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r
    FROM (SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
      CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) AS tp
    FROM (SELECT COUNT(CASE WHEN {label} = 0 AND {prediction} = 0 THEN 1 END) AS tn,
      COUNT(CASE WHEN {label} = 0 AND {prediction} = 1 THEN 1 END) AS fp,
      COUNT(CASE WHEN {label} = 1 AND {prediction} = 0 THEN 1 END) AS fn,
      COUNT(CASE WHEN {label} = 1 AND {prediction} = 1 THEN 1 END) AS tp FROM {source}) a) b) c"""


_RATES = ("accuracy", "precision", "recall", "f1_score")
_VOTE = "CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END"


@query(
    "confusion_metrics",
    raw_sql(_confusion_sql("label", "prediction", f"(SELECT label, {_VOTE} AS prediction FROM labelled) l"), SCORED, _LABELLED),
)
def confusion_metrics(spark, sf_dir):
    rows = _labelled(spark, sf_dir).withColumn("prediction", (F.col("churn_probability") >= 0.5).cast("int"))
    return rounded_columns(metrics.confusion_metrics(rows), 6, *_RATES)


_DOCUMENTS = """(SELECT quality AS label, CASE WHEN n_chars >= 2000 THEN 1 ELSE 0 END AS prediction
FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


@query("confusion_metrics_documents", _confusion_sql("label", "prediction", _DOCUMENTS + " t"))
def confusion_metrics_documents(spark, sf_dir):
    return rounded_columns(metrics.confusion_metrics(_graded(spark, sf_dir)), 6, *_RATES)


def _graded(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(documents, "doc_id").select(
        F.col("quality").alias("label"), (F.col("n_chars") >= 2000).cast("int").alias("prediction")
    )


def _auc_sql(source: str) -> str:
    return f"""SELECT CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives,
      {rounded('SUM(pos * (below + neg / 2)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg))', 6)} AS roc_auc
    FROM (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT s, COUNT(CASE WHEN y = 1 THEN 1 END) AS pos, COUNT(CASE WHEN y = 0 THEN 1 END) AS neg
        FROM {source} GROUP BY s) g) r"""


@query(
    "roc_auc",
    raw_sql(_auc_sql("(SELECT label AS y, churn_probability AS s FROM labelled) l"), SCORED, _LABELLED),
)
def roc_auc(spark, sf_dir):
    return rounded_columns(metrics.roc_auc(_labelled(spark, sf_dir), score="churn_probability"), 6, "roc_auc")


@query(
    "roc_auc_orders",
    _auc_sql("(SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS y, o_totalprice AS s FROM orders) o"),
)
def roc_auc_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 3 == 0).cast("int").alias("label"), F.col("o_totalprice").alias("score")
    )
    return rounded_columns(metrics.roc_auc(rows), 6, "roc_auc")


def _report_sql(source: str) -> str:
    return f"""per AS (SELECT class, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p,
      CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r, support, hits FROM (
      SELECT c AS class, COUNT(CASE WHEN y = c THEN 1 END) AS support, COUNT(CASE WHEN p = c THEN 1 END) AS predicted,
        COUNT(CASE WHEN y = c AND p = c THEN 1 END) AS hits
      FROM (SELECT CAST(label AS VARCHAR) AS y, CAST(prediction AS VARCHAR) AS p FROM {source} t) t
      CROSS JOIN (SELECT '0' AS c UNION ALL SELECT '1') k GROUP BY c) q),
    scores AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM per)
    SELECT class, {rounded('p', 6)} AS precision, {rounded('r', 6)} AS recall, {rounded('f', 6)} AS f1_score, support FROM scores
    UNION ALL SELECT 'accuracy', NULL, NULL, {rounded('SUM(hits) / SUM(support)', 6)}, CAST(SUM(support) AS BIGINT) FROM scores
    UNION ALL SELECT 'macro avg', {rounded('AVG(p)', 6)}, {rounded('AVG(r)', 6)}, {rounded('AVG(f)', 6)}, CAST(SUM(support) AS BIGINT) FROM scores
    UNION ALL SELECT 'weighted avg', {rounded('SUM(p * support) / SUM(support)', 6)}, {rounded('SUM(r * support) / SUM(support)', 6)},
      {rounded('SUM(f * support) / SUM(support)', 6)}, CAST(SUM(support) AS BIGINT) FROM scores"""


@query("classification_report", "WITH " + _report_sql(_DOCUMENTS))
def classification_report(spark, sf_dir):
    return rounded_columns(metrics.classification_report(_graded(spark, sf_dir)), 6, "precision", "recall", "f1_score")


# -- clusters ------------------------------------------------------------------

_CENTERS = """means AS (SELECT label, i, AVG(CAST(embedding[i] AS DOUBLE)) AS m
  FROM embeddings CROSS JOIN range(1, 65) r(i) GROUP BY label, i),
gaps AS (SELECT vec_id, m.label AS c, SUM((CAST(embedding[i] AS DOUBLE) - m.m) ** 2) AS d
  FROM embeddings e JOIN means m ON TRUE GROUP BY vec_id, m.label),
nearest AS (SELECT vec_id, c AS segment, d FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY d, c) AS place FROM gaps) g WHERE place = 1)"""


def _nearest(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings")
    centers = clusters.centroids(points, "embedding", "label").collect()
    ordered = sorted((r["cluster"], r["centroid"]) for r in centers)
    return clusters.assign_nearest(points, "embedding", ordered)


@query(
    "nearest_centroid",
    f"WITH {_CENTERS} SELECT vec_id, segment, {rounded('sqrt(d)', 6)} AS segment_distance FROM nearest",
)
def nearest_centroid(spark, sf_dir):
    return rounded_columns(_nearest(spark, sf_dir).select("vec_id", "segment", "segment_distance"), 6, "segment_distance")


@query(
    "cluster_metrics",
    f"""WITH {_CENTERS} SELECT segment AS cluster, COUNT(*) AS size, {rounded('SUM(d)', 4)} AS inertia FROM nearest GROUP BY segment""",
)
def cluster_metrics(spark, sf_dir):
    return rounded_columns(clusters.cluster_metrics(_nearest(spark, sf_dir)), 4, "inertia")


def _silhouette_sql(distance: str) -> str:
    return f"""WITH pairs AS (SELECT a.vec_id AS id, a.label AS own, b.label AS c,
      {distance} AS d FROM embeddings a CROSS JOIN embeddings b WHERE a.vec_id <> b.vec_id),
    means AS (SELECT id, own, c, AVG(d) AS m FROM pairs GROUP BY id, own, c),
    parts AS (SELECT id, MAX(CASE WHEN c = own THEN m END) AS a, MIN(CASE WHEN c <> own THEN m END) AS b FROM means GROUP BY id)
    SELECT COUNT(*) AS points, {rounded('AVG(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END)', 6)} AS silhouette
    FROM parts"""


_GAP = "list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


@query("silhouette", _silhouette_sql(f"{_GAP} ** 2"))
def silhouette(spark, sf_dir):
    return rounded_columns(clusters.silhouette_squared(table(spark, sf_dir, "embeddings"), "embedding", "label"), 6, "silhouette")


@query("silhouette_exact", _silhouette_sql(_GAP))
def silhouette_exact(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings")
    return rounded_columns(clusters.silhouette_exact(points, "vec_id", "embedding", "label"), 6, "silhouette")
