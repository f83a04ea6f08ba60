"""Many k-means runs over one table, advanced together.

Every restart of every number of clusters takes its step in the same pass. Seeds
are drawn as in k-means++: the next centre of a run is a row chosen with a
probability in proportion to its squared distance from the nearest centre so far.
Exponential races make that one mergeable minimum per run: a row's time is an
exponential draw over its weight, and the earliest row of all wins. Then Lloyd's
passes add up rows and counts by nearest centre. Tasks return sums per run, the
driver holds the centres of all runs, and nothing grows with the rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from stayline.operators.logistic import _collected, _matrices, row_blocks

#: Lloyd's passes at most, and the movement of a centre that counts as none.
PASSES, TOLERANCE = 20, 1e-4


@dataclass(frozen=True)
class Run:
    clusters: int
    seed: int


def feature_blocks(train: DataFrame) -> DataFrame:
    """The ``features`` of all rows as a written table of blocks; labels play no part."""
    return row_blocks(train.withColumn("label", F.lit(0.0)), [])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for matrix in _matrices(batches):
        yield matrix[:, 2:]


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    found = np.square(x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + np.square(centres).sum(axis=1)
    return np.maximum(found, 0)


def _races(runs: Sequence[int], seeds: Sequence[int], centres: Sequence[np.ndarray]):
    """Per run the earliest row: its time, then its features."""

    edges = np.cumsum([0, *map(len, centres)])
    stacked = np.concatenate(centres)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for x in _features(batches):
            content = zlib.crc32(np.ascontiguousarray(x))
            distances = _distances(stacked, x)
            for run, seed, low, high in zip(runs, seeds, edges, edges[1:]):
                weight = distances[low:high].min(axis=0) if high > low else np.ones(len(x))
                random = np.random.default_rng([seed, int(high - low), content])
                with np.errstate(divide="ignore"):
                    times = random.standard_exponential(len(x)) / weight
                at = int(times.argmin())
                if run not in best or times[at] < best[run][0]:
                    best[run] = np.concatenate([[times[at]], x[at]])
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.int32()), pa.array([b.tobytes() for b in best.values()], pa.binary())], ["fit", "sums"]
            )

    return task


def _earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best: dict[int, np.ndarray] = {}
    for batch in batches:
        for run, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = np.frombuffer(row)
            if run not in best or tuple(values) < tuple(best[run]):
                best[run] = values
    if best:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(best), pa.int32()), pa.array([b.tobytes() for b in best.values()], pa.binary())], ["fit", "sums"]
        )


def _assigned(runs: Sequence[int], centres: Sequence[np.ndarray]):
    """Per run: cost, then rows and feature sums of every cluster."""
    edges = np.cumsum([0, *map(len, centres)])
    stacked = np.concatenate(centres)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, counts, sums = np.zeros(len(centres)), np.zeros(len(stacked)), np.zeros(stacked.shape)
        for x in _features(batches):
            distances = _distances(stacked, x)
            member = np.zeros(distances.shape)
            for run, (low, high) in enumerate(zip(edges, edges[1:])):
                least = distances[low:high].min(axis=0)
                costs[run] += least.sum()
                open_ = np.ones(len(x), bool)
                for centre in range(low, high):  # the first of equally near centres
                    member[centre] = mine = open_ & (distances[centre] == least)
                    open_ &= ~mine
            counts += member.sum(axis=1)
            sums += member @ x
        totals = [np.concatenate([[c], counts[a:b], sums[a:b].reshape(-1)]) for c, a, b in zip(costs, edges, edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(runs), pa.int32()), pa.array([t.tobytes() for t in totals], pa.binary())], ["fit", "sums"]
        )

    return task


def fit_runs(blocks: DataFrame, size: int, runs: Sequence[Run]) -> list[tuple[float, np.ndarray]]:
    """Cost and centres of every run, in order.

    A table with fewer distinct rows than clusters repeats centres; an empty one
    gives cost 0 and no centres.
    """
    centres = [np.empty((0, size)) for _ in runs]
    for j in range(max((r.clusters for r in runs), default=0)):
        open_ = [i for i, r in enumerate(runs) if r.clusters > j]
        found = _collected(blocks, _races(open_, [runs[i].seed for i in open_], [centres[i] for i in open_]), _earliest)
        if not found:
            return [(0.0, c) for c in centres]
        for i in open_:
            centres[i] = np.vstack([centres[i], found[i][1:]])
    open_ = list(range(len(runs)))
    for _ in range(PASSES):
        found = _collected(blocks, _assigned(open_, [centres[i] for i in open_]))
        moving = []
        for i in open_:
            k = runs[i].clusters
            counts, sums = found[i][1 : 1 + k, None], found[i][1 + k :].reshape(k, size)
            moved = np.where(counts > 0, sums / np.maximum(counts, 1), centres[i])  # an empty cluster stays
            if np.linalg.norm(moved - centres[i], axis=1).max() > TOLERANCE:
                moving.append(i)
            centres[i] = moved
        open_ = moving
        if not open_:
            break
    costs = _collected(blocks, _assigned(range(len(runs)), centres))
    return [(float(costs[i][0]), centres[i]) for i in range(len(runs))]


def with_clusters(df: DataFrame, centres: Sequence[np.ndarray], features: str = "features") -> DataFrame:
    """(features, clusters): the cluster of every row under each of several sets of centres."""
    edges = np.cumsum([0, *map(len, centres)])
    stacked = np.concatenate(centres)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            distances = _distances(x, stacked)
            found = np.column_stack([distances[:, a:b].argmin(axis=1) for a, b in zip(edges, edges[1:])]).astype(np.int32)
            offsets = pa.array(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), pa.ListArray.from_arrays(offsets, pa.array(found.reshape(-1)))], ["x", "clusters"]
            )

    rows = df.select(vector_to_array(features).alias("x")).mapInArrow(task, "x array<double>, clusters array<int>")
    return rows.select(array_to_vector("x").alias("features"), "clusters")
