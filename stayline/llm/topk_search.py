"""Exact top-k search by inner product: columnar branch and bound.

Candidates are laid out dimension by dimension. A query accumulates its products
one block of dimensions at a time; after each block a candidate whose partial
score plus the most that its remaining dimensions can add (product of the
remaining norms) falls short of the k-th best so far is dropped, and the
survivors are compacted. Scores are integers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from stayline.session import scratch_path, staged

#: A component x counts as floor(SCALE * x).
SCALE = 1024
#: Candidates in a columnar block, dimensions in a step, queries in one broadcast.
BLOCK_ROWS, STEP, QUERY_BYTES = 8_192, 8, 8 << 20
#: Within these bounds int64 sums cannot overflow and float64 bounds are safe.
_SAFE = float(2**62)
_LONG = (-(2**63), 2**63 - 1)


def whole_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v): components as floor(SCALE * x); rows with a null or non-finite component or id are left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.coalesce(fine, F.lit(False)))
    # floor() of a double beyond a long saturates at the long's ends, in Spark as here.
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))


def remaining_norms(rows: np.ndarray) -> np.ndarray:
    """Per step the norm of what follows it, shape (steps, rows), a little too large rather than too small."""
    squares = np.square(rows.astype(np.float64)).cumsum(axis=1)
    ends = np.minimum(np.arange(STEP, rows.shape[1] + STEP, STEP), rows.shape[1])
    left = squares[:, -1:] - squares[:, ends - 1]
    # Rounding of the running sums is far below this share of the whole.
    return np.sqrt(np.maximum(left, 0) + squares[:, -1:] * 1e-9).T


class Best:
    """The k best rows of one query so far; ties go to the smaller id."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.empty(0, dtype=object)
        self.ids = np.empty(0, dtype=np.int64)

    @property
    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores.astype(scores.dtype) if len(self.scores) else scores[:0], scores])
        ids = np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores)) if scores.dtype != object else sorted(
            range(len(ids)), key=lambda i: (-scores[i], ids[i])
        )
        order = np.asarray(order, dtype=np.int64)[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_block(query: np.ndarray, own: int, norms: np.ndarray, columns: np.ndarray, ids: np.ndarray,
                 rest: np.ndarray, best: Best) -> None:
    """Update ``best`` with the candidates of one columnar block (dimensions x rows)."""
    alive = np.flatnonzero(ids != own)
    partial = np.zeros(len(alive), dtype=np.int64)
    block = columns if len(alive) == len(ids) else columns[:, alive]
    for step in range(rest.shape[0]):
        dims = slice(step * STEP, (step + 1) * STEP)
        partial = partial + query[dims] @ block[dims]
        if best.floor == -np.inf or step + 1 == rest.shape[0]:
            continue
        reach = partial + norms[step] * rest[step, alive]
        stays = reach >= best.floor - 1e-6 * abs(best.floor) - 1
        if stays.mean() < 0.7:  # compact
            alive, partial, block = alive[stays], partial[stays], block[:, stays]
            if not len(alive):
                return
    if len(partial) > best.k and best.floor == -np.inf:
        cut = np.partition(partial, len(partial) - best.k)[len(partial) - best.k]
        top = partial >= cut
        partial, alive = partial[top], alive[top]
    elif best.floor > -np.inf:
        top = partial >= best.floor
        partial, alive = partial[top], alive[top]
    if len(partial):
        best.add(partial, ids[alive])


def _big_scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of components too large for int64 sums, held at the ends of a long."""
    q = [int(c) for c in query]
    exact = [sum(a * int(b) for a, b in zip(q, row)) for row in rows]
    return np.array([min(_LONG[1], max(_LONG[0], s)) for s in exact], dtype=object)


def _matrix(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: row numbers and their vectors as int64 rows."""
    offsets = vectors.offsets.to_numpy()
    lengths = np.diff(offsets)
    values = vectors.values.to_numpy(zero_copy_only=False)
    return {
        int(n): (at := np.flatnonzero(lengths == n), values[offsets[at][:, None] + np.arange(n)])
        for n in np.unique(lengths)
    }


def _searcher(queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int):
    """``queries`` by dimension: ids, vectors and how many rows of the table each stands for."""

    def search(held: dict[int, list], best: dict, n: int) -> None:
        ids = np.concatenate([i for i, _ in held[n]])
        rows = np.concatenate([r for _, r in held[n]])
        held[n] = []
        own_ids, own_rows, _ = queries[n]
        largest = float(np.abs(own_rows.astype(np.float64)).max(initial=0)) * float(
            np.abs(rows.astype(np.float64)).max(initial=0)
        )
        safe = largest * max(n, 1) < _SAFE
        columns, rest, norms = None, None, None
        if safe and n:
            columns, rest, norms = np.ascontiguousarray(rows.T), remaining_norms(rows), remaining_norms(own_rows)
        for at in range(len(own_ids)):
            found = best.setdefault((n, at), Best(k))
            if columns is None:
                other = ids != own_ids[at]
                scores = _big_scores(own_rows[at], rows[other]) if n else np.zeros(int(other.sum()), dtype=object)
                found.add(scores, ids[other])
            else:
                if found.scores.dtype == object and len(found.scores):
                    found.scores = found.scores.astype(np.int64)
                search_block(own_rows[at], int(own_ids[at]), norms[:, at], columns, ids, rest, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {n: [] for n in queries}
        best: dict[tuple[int, int], Best] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            all_ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            for n, (at, rows) in _matrix(batch.column("v")).items():
                if n in queries:
                    held[n].append((all_ids[at], rows))
                    if sum(len(i) for i, _ in held[n]) >= BLOCK_ROWS:
                        search(held, best, n)
        for n in held:
            if held[n]:
                search(held, best, n)
        for n, (own_ids, _, copies) in queries.items():
            for at, own in enumerate(own_ids.tolist()):
                if (found := best.get((n, at))) and len(found.ids):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(found.ids), own)),
                            pa.array(found.ids),
                            pa.array([int(s) for s in found.scores], pa.int64()),
                            pa.array(np.full(len(found.ids), copies[at])),
                        ],
                        ["query_id", "vec_id", "score", "copies"],
                    )

    return run


def top_k(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """Per query its k highest scores: query_id, rank, vec_id, score.

    ``vectors`` is (vec_id, embedding), ``is_query`` a condition on ``vec_id``.
    Every row but those with the query's own id is a candidate; only vectors of
    the same dimension are compared (of dimension 0 all score 0). Ties go to the
    smaller id. Rows take places, not ids: repeated rows take one place each, and
    where several rows hold a query's id, each asks for itself and the k best of
    all their answers count. Scores beyond a long are held at its ends.

    The query set is stated, so all queries meet all candidates, but in blocks:
    queries are taken in turns of at most :data:`QUERY_BYTES`, each broadcast to
    tasks that stream their own candidates and return k rows per query. A turn's
    answers are written before the next turn starts, so neither the driver nor the
    plan holds more than one turn. Equal query rows are asked once.
    """
    table = staged(whole_vectors(vectors), "vectors")
    spark = table.sparkSession
    asked = table.where(is_query).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))
    # More than k equal query rows fill the k places just as k do.
    asked = asked.select("vec_id", "v", F.least("n", F.lit(k)).alias("copies"))
    width = asked.agg(F.coalesce(F.sum(F.size("v") * 8 + 24), F.lit(0)).alias("b")).first()["b"]
    turns = max(1, -(-int(width) // QUERY_BYTES))
    asked = staged(asked.withColumn("turn", F.pmod(F.xxhash64("vec_id", "v"), F.lit(turns))), "queries")
    path, kind = scratch_path(spark, "answers"), "query_id long, vec_id long, score long, copies long"
    spark.createDataFrame([], kind).write.parquet(path)
    for turn in range(turns):
        batch = asked.where(F.col("turn") == turn).select("vec_id", "v", "copies").toArrow()
        if not batch.num_rows:
            continue
        ids, copies = (batch.column(c).to_numpy() for c in ("vec_id", "copies"))
        by_size = _matrix(batch.column("v").combine_chunks())
        queries = {n: (ids[at], rows, copies[at]) for n, (at, rows) in by_size.items()}
        table.mapInArrow(_searcher(queries, k), kind).write.mode("append").parquet(path)
    found = spark.read.schema(kind).parquet(path)
    every = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
