"""Nearest centroid, cluster sizes and inertia, silhouettes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from stayline.session import staged

#: Points per tile of the exact silhouette, and distances that a task holds at a time.
TILE, STRIP = 4_000, 1 << 18


def centroids(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """(cluster, size, centroid): mean vector of each cluster, combined on the map side."""
    points = df.select(F.col(cluster).alias("cluster"), array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    return points.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), vector_to_array(Summarizer.mean(F.col("v"))).alias("centroid")
    )


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two numeric arrays."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, d: total + d
    )


def assign_nearest(
    df: DataFrame,
    vector: str,
    centers: list[tuple[int, list[float]]],
    segment: str = "segment",
    distance: str = "segment_distance",
) -> DataFrame:
    """Add the nearest centre's label and the Euclidean distance to it.

    ``centers`` is the model: a handful of labelled vectors inlined as literals.
    The lowest label wins a tie.
    """
    v = F.col(vector).cast("array<double>")
    candidates = [
        F.struct(
            squared_distance(v, F.array(*[F.lit(float(x)) for x in center])).alias("d"),
            F.lit(label).alias("label"),
        )
        for label, center in centers
    ]
    nearest = F.array_min(F.array(*candidates))
    return (
        df.withColumn("_nearest", nearest)
        .withColumns({segment: F.col("_nearest.label"), distance: F.sqrt(F.col("_nearest.d"))})
        .drop("_nearest")
    )


def cluster_metrics(df: DataFrame, segment: str = "segment", distance: str = "segment_distance") -> DataFrame:
    """(cluster, size, inertia) per cluster; the inertia is the sum of squared distances."""
    return df.groupBy(F.col(segment).alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.col(distance) * F.col(distance)).alias("inertia")
    )


def cluster_totals(metrics: DataFrame) -> DataFrame:
    """One row: n_clusters, points and total inertia."""
    return metrics.agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.sum("size").alias("points"),
        F.sum("inertia").alias("inertia"),
    )


def silhouette_squared(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """One row: points and mean silhouette under squared Euclidean distance.

    The mean squared distance of a point to a cluster follows from the
    cluster's size, mean vector and mean squared norm, so no pair of points is
    formed and the cost is linear. This is the scalable definition; it differs
    from the plain Euclidean one. -1 when there is only one cluster.
    """
    points = df.select(F.col(cluster).alias("cluster"), F.col(vector).cast("array<double>").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)
    stats = (
        points.select("cluster", array_to_vector("v").alias("x"), norm.alias("norm"))
        .groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("size"),
            vector_to_array(Summarizer.mean(F.col("x"))).alias("mean"),
            F.avg("norm").alias("norm"),
        )
        .collect()
    )
    if len(stats) < 2:
        return df.agg(F.count(F.lit(1)).alias("points"), F.lit(-1.0).alias("silhouette"))

    def mean_distance(row) -> Column:
        dot = F.aggregate(
            F.zip_with("v", F.array(*[F.lit(x) for x in row["mean"]]), lambda a, b: a * b),
            F.lit(0.0),
            lambda t, x: t + x,
        )
        return F.greatest(norm + F.lit(row["norm"]) - 2 * dot, F.lit(0.0))

    distances = F.array(
        *[
            F.struct(
                mean_distance(r).alias("d"), F.lit(r["cluster"]).alias("cluster"), F.lit(r["size"]).alias("size")
            )
            for r in stats
        ]
    )
    scored = points.withColumn("_all", distances)
    own = F.element_at(F.filter("_all", lambda x: x["cluster"] == F.col("cluster")), 1)
    other = F.array_min(
        F.transform(F.filter("_all", lambda x: x["cluster"] != F.col("cluster")), lambda x: x["d"])
    )
    a = own["d"] * own["size"] / F.nullif(own["size"] - 1, F.lit(0))
    parts = scored.select(own["size"].alias("size"), a.alias("a"), other.alias("b"))
    return parts.agg(F.count(F.lit(1)).alias("points"), F.avg(_silhouette()).alias("silhouette"))


def _silhouette() -> Column:
    a, b = F.col("a"), F.col("b")
    return F.when((F.col("size") == 1) | (F.greatest(a, b) == 0), 0.0).otherwise((b - a) / F.greatest(a, b))


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``, from one matrix product.

    Where the product cancels, that is for rows that are close for their length, the
    distance is taken from the difference itself, so equal rows have distance 0.
    """
    long_a, long_b = np.square(a).sum(axis=1)[:, None], np.square(b).sum(axis=1)
    found = a @ b.T
    found *= -2
    found += long_a
    found += long_b
    # The product's error is some 1e-15 of the lengths; what is below 1e-6 of them is taken again.
    close_a, close_b = np.nonzero(~(found > 1e-6 * (long_a + long_b)))
    for at in range(0, len(close_a), 65_536):
        i, j = close_a[at : at + 65_536], close_b[at : at + 65_536]
        found[i, j] = np.square(a[i] - b[j]).sum(axis=1)
    return np.sqrt(found, out=found)


def _packed(tile: int, parts: int):
    """Tiles of at most a quarter over ``tile`` rows: ids, clusters and the vectors as one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for batch in batches:
            cuts = -(-batch.num_rows // (tile + tile // 4))
            for part in range(cuts):
                low, high = part * batch.num_rows // cuts, (part + 1) * batch.num_rows // cuts
                rows = batch.slice(low, high - low)
                if rows.column("v").null_count:
                    raise ValueError("every point needs a vector")
                block = rows.column("v").flatten().to_numpy(zero_copy_only=False).astype("<f8", copy=False)
                lists = [pa.ListArray.from_arrays([0, rows.num_rows], rows.column(c)) for c in ("id", "cluster")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), *lists, pa.array([block.tobytes()], pa.binary())],
                    ["tile", "id", "cluster", "block"],
                )
                number += parts

    return run


def _measured(schema: pa.Schema):
    """Of a pair of tiles: each point's distances to the points of the other, added up by their clusters."""

    def unpacked(table: pa.Table):
        ids, own = (table.column(c).combine_chunks().flatten() for c in ("id", "cluster"))
        x = np.frombuffer(table.column("block")[0].as_py(), "<f8").reshape(len(ids), -1)
        labels = own.drop_null().unique()
        codes = pc.index_in(own, labels).fill_null(len(labels)).to_numpy()
        return ids, own, x, labels, np.eye(len(labels) + 1)[codes][:, :-1]  # a point without a cluster is in none

    def totals(ids: pa.Array, own: pa.Array, labels: pa.Array, sums: np.ndarray) -> pa.Table:
        points, found = np.repeat(np.arange(len(ids)), len(labels)), np.tile(np.arange(len(labels)), len(ids))
        return pa.Table.from_arrays([ids.take(points), own.take(points), labels.take(found), pa.array(sums.reshape(-1))], schema=schema)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        a_ids, a_own, a, a_labels, a_member = unpacked(left)
        b_ids, b_own, b, b_labels, b_member = unpacked(right)
        a_sums, b_sums = np.zeros((len(a), len(b_labels))), np.zeros((len(b), len(a_labels)))
        same = key[0].as_py() == key[1].as_py()
        step = max(1, STRIP // max(len(b), 1))
        for at in range(0, len(a), step):
            gaps = _gaps(a[at : at + step], b)
            a_sums[at : at + step] = gaps @ b_member
            if not same:
                b_sums += gaps.T @ a_member[at : at + step]
        ours = totals(a_ids, a_own, b_labels, a_sums)
        return ours if same else pa.concat_tables([ours, totals(b_ids, b_own, a_labels, b_sums)])

    return run


def silhouette_exact(df: DataFrame, id_column: str, vector: str, cluster: str, tile: int = TILE) -> DataFrame:
    """One row: points and mean silhouette under plain Euclidean distance.

    Mean Euclidean distances cannot be taken from cluster summaries, so every
    point is measured against every other one: quadratic work, meant for
    samples. Points are packed into tiles of about ``tile`` points; a task
    compares two tiles by a matrix product, strip by strip, and emits one distance
    sum per point and cluster, never a pair. A pair of tiles is compared once, for
    the points of both. Use :func:`silhouette_squared` for whole populations.
    """
    points = df.select(
        F.col(id_column).alias("id"),
        F.col(cluster).alias("cluster"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    kind = dict(points.dtypes)
    tasks = max(1, -(-points.count() // tile))
    schema = f"tile long, id array<{kind['id']}>, cluster array<{kind['cluster']}>, block binary"
    tiles = staged(points.repartition(tasks).mapInArrow(_packed(tile, tasks), schema), "tiles")
    sizes = points.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    numbers = tiles.select("tile")
    pairs = numbers.select(F.col("tile").alias("i")).join(numbers.select(F.col("tile").alias("j")), F.col("i") <= F.col("j"))
    names = ["i", "j", "id", "cluster", "block"]
    left, right = (
        tiles.join(pairs, F.col("tile") == F.col(side)).select(*names).toDF(*names) for side in ("i", "j")
    )
    result = StructType([
        StructField("id", points.schema["id"].dataType), StructField("own", points.schema["cluster"].dataType),
        StructField("cluster", points.schema["cluster"].dataType), StructField("total", DoubleType()),
    ])
    sums = (
        left.groupBy("i", "j")
        .cogroup(right.groupBy("i", "j"))
        .applyInArrow(_measured(to_arrow_schema(result)), result)
        .groupBy("id", "own", "cluster")
        .agg(F.sum("total").alias("total"))
        .join(sizes, "cluster")
    )
    mine = F.col("own") == F.col("cluster")
    parts = sums.groupBy("id").agg(
        F.max(F.when(mine, F.col("size"))).alias("size"),
        F.max(F.when(mine, F.col("total") / F.nullif(F.col("size") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~mine, F.col("total") / F.col("size"))).alias("b"),
    )
    return parts.agg(
        F.count(F.lit(1)).alias("points"),
        F.when(F.count("b") == 0, F.lit(-1.0)).otherwise(F.avg(_silhouette())).alias("silhouette"),
    )
