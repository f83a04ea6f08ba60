"""Many penalised logistic regressions over one table, fitted together.

A grid search fits the same rows again and again under other penalties and class
weights. Here one pass over the data serves every open fit: a task adds up loss,
gradient and curvature of all of them over its blocks of rows, and those partial
sums (fits x features²; nothing that grows with the rows) are added up by fit.
The task that adds up a fit's sums also finds its next proximal Newton step, the
exact minimum of the quadratic model, and returns that step alone, so neither
curvatures nor their solution pass through the driver. About ten passes settle a
whole grid, where one quasi-Newton fit alone needs one or two hundred.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from stayline.session import settle_worker, staged

#: Rows of a block, and of the part of it that is added up at a time, small enough for a core's cache.
BLOCK_ROWS, SLICE_ROWS = 4_096, 512
#: A fit is settled when no standardised coefficient of its next step moves further than this, or a step gains nothing.
TOLERANCE = 1e-7
#: Passes over the data and halvings of a step at most; in a step, rounds of so many sweeps
#: over the coordinates, then moves of an exact search.
PASSES, HALVINGS, ROUNDS, SWEEPS, MOVES = 100, 30, 3, 10, 1_000
#: Bytes of partial sums in one task. Wider problems are for one-by-one fits.
SUM_BYTES = 256 << 20


@dataclass(frozen=True)
class Penalty:
    """``strength`` x (``mix`` x L1 + (1 - ``mix``) / 2 x L2²) on the mean weighted loss; the intercept is free."""

    strength: float
    mix: float
    weight: str


def fits_in_driver(size: int, fits: int) -> bool:
    return fits * (size + 1) ** 2 * 8 <= SUM_BYTES


def _blocks(weights: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                own = [part.column(c).to_numpy(zero_copy_only=False) for c in ("label", *weights)]
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                matrix = np.column_stack([*own, np.ones(part.num_rows), x])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([matrix.shape[1]]), pa.array([matrix.tobytes()], pa.binary())], ["width", "block"]
                )

    return run


def row_blocks(train: DataFrame, weights: Sequence[str], features: str = "features") -> DataFrame:
    """Labelled rows as a written table of dense blocks: label, the weights, one, the features."""
    rows = train.where(F.col("label").isNotNull()).select(
        F.col("label").cast("double"), *[F.col(w).cast("double") for w in weights], vector_to_array(features).alias("x")
    )
    return staged(rows.mapInArrow(_blocks(weights), "width long, block binary"), "blocks")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    settle_worker()
    for batch in batches:
        for width, block in zip(batch.column("width").to_pylist(), batch.column("block").to_pylist()):
            yield np.frombuffer(block).reshape(-1, width)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for matrix in _matrices(batches):
        for at in range(0, len(matrix), SLICE_ROWS):
            yield matrix[at : at + SLICE_ROWS]


def _sums(chosen: Sequence[int], weight_of: Sequence[int], weights: int, coefficients: np.ndarray, centre: np.ndarray, scale: np.ndarray):
    """Per fit: weight total, loss, gradient, curvature, in one row each; features are standardised on the way."""
    fits, size = coefficients.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((fits, 2 + size + size * size))
        for matrix in _slices(batches):
            label, x = matrix[:, 0], (matrix[:, 1 + weights :] - centre) / scale
            margin = x @ coefficients.T
            # log(1 + e^m) - y m and the probability, without overflow
            loss = np.logaddexp(0.0, margin) - label[:, None] * margin
            probability = np.exp(np.minimum(margin, 0)) / (1 + np.exp(-np.abs(margin)))
            for fit in range(fits):
                w = matrix[:, 1 + weight_of[fit]]
                p = probability[:, fit]
                totals[fit, 0] += w.sum()
                totals[fit, 1] += w @ loss[:, fit]
                totals[fit, 2 : 2 + size] += x.T @ (w * (p - label))
                # One array times itself: half the work of two different ones.
                root = x * np.sqrt(w * p * (1 - p))[:, None]
                totals[fit, 2 + size :] += (root.T @ root).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(chosen), pa.int32()), pa.array([t.tobytes() for t in totals], pa.binary())], ["fit", "sums"]
        )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one key added up as they stream by; a task holds one array per key."""
    settle_worker()
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for key, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = np.frombuffer(sums)
            totals[key] = totals[key] + values if key in totals else values
    if totals:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], ["fit", "sums"]
        )


def _collected(blocks: DataFrame, task, merge=_added, tasks: int | None = None) -> dict[int, np.ndarray]:
    """What tasks return per fit, merged by fit in ``tasks`` tasks, or as few as the sums need."""
    partial = blocks.mapInArrow(task, "fit int, sums binary")
    dealt = partial.repartition("fit") if tasks is None else partial.repartition(tasks, "fit")
    rows = dealt.mapInArrow(merge, "fit int, sums binary").toArrow()
    return {k: np.frombuffer(v) for k, v in zip(rows.column("fit").to_pylist(), rows.column("sums").to_pylist())}


def _moments(weights: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matrix in _matrices(batches):
            x = matrix[:, 1 + weights :]
            sums = np.concatenate([[len(x)], x.sum(axis=0), np.square(x).sum(axis=0)])
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["fit", "sums"])

    return run


def _settled_point(now, at, gradient, curvature, l1, l2):
    """The minimum of one quadratic model if it has the zeros and signs of ``now``, else None."""
    active = (now != 0) | (l1 == 0)
    signs = np.sign(now[active])
    matrix = curvature[np.ix_(active, active)] + np.diag(l2[active] + 1e-12)
    point = np.zeros_like(now)
    point[active] = np.linalg.solve(matrix, curvature[active] @ at - gradient[active] - l1[active] * signs)
    slope = gradient + curvature @ (point - at)
    kept = (np.sign(point[active]) == signs) | (l1[active] == 0)
    return point if kept.all() and (np.abs(slope[~active]) <= l1[~active] + 1e-10).all() else None


def _minimum(now, at, gradient, curvature, l1, l2):
    """The minimum of one quadratic model plus penalties, by a search over signs from ``now``.

    Given which coordinates are zero and the signs of the others, the minimum is a linear
    system. The point goes towards its solution until the first coordinate reaches zero,
    which then stays there; at a solution, the zero coordinate that pulls the most beyond
    its penalty is let go. Every move descends, so no choice of signs comes twice.
    """
    matrix = curvature + np.diag(l2 + 1e-12)
    base, free = gradient - curvature @ at, l1 == 0
    now, signs = now.copy(), np.sign(now)
    solved = False
    for _ in range(MOVES):
        if solved:
            slope = base + matrix @ now
            excess = np.where((signs != 0) | free, -np.inf, np.abs(slope) - l1)
            most = int(np.argmax(excess))
            if excess[most] <= 1e-10:
                break
            signs[most] = -np.sign(slope[most])
        active = np.flatnonzero((signs != 0) | free)
        target = np.linalg.solve(matrix[np.ix_(active, active)], -base[active] - l1[active] * signs[active])
        crossing = (np.sign(target) != signs[active]) & ~free[active]
        solved = not crossing.any()
        if solved:
            now[active] = target
            continue
        share = np.full(len(active), np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            share[crossing] = (now[active] / (now[active] - target))[crossing]
        share[np.isnan(share)] = 0.0
        now[active] += share.min() * (target - now[active])
        stopped = active[share <= share.min()]
        now[stopped] = signs[stopped] = 0.0
    return now


def _descended(at, gradient, curvature, l1, l2):
    """Steps to the minima of the quadratic models plus penalties, for all fits at once.

    A few sweeps over the coordinates find which are zero and the signs of the
    others; given those, the minimum is a linear system, whose solution is checked.
    Fits that are not settled then search on from where the sweeps came to.
    ``l1`` and ``l2`` are (fits, size); the intercept's are zero.
    """
    now = at.copy()
    open_ = np.arange(len(at))
    for _ in range(ROUNDS):
        for fit in open_:
            point = _settled_point(now[fit], at[fit], gradient[fit], curvature[fit], l1[fit], l2[fit])
            if point is not None:
                now[fit] = point
                open_ = open_[open_ != fit]
        if not len(open_):
            break
        h, moving = np.ascontiguousarray(curvature[open_].transpose(2, 0, 1)), now[open_]
        diagonal = np.einsum("jfj->fj", h) + 1e-12
        slope = gradient[open_] + np.einsum("jfi,fj->fi", h, moving - at[open_])  # of the loss's model
        for _ in range(SWEEPS):
            for j in range(at.shape[1]):
                target = diagonal[:, j] * moving[:, j] - slope[:, j]
                best = np.sign(target) * np.maximum(np.abs(target) - l1[open_, j], 0) / (diagonal[:, j] + l2[open_, j])
                slope += h[j] * (best - moving[:, j])[:, None]
                moving[:, j] = best
        now[open_] = moving
    for fit in open_:
        now[fit] = _minimum(now[fit], at[fit], gradient[fit], curvature[fit], l1[fit], l2[fit])
    return now - at


def _reached(sums: np.ndarray, trial: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """Penalised mean losses at ``trial``, one per row of sums."""
    return sums[:, 1] / sums[:, 0] + (l1 * np.abs(trial)).sum(axis=1) + (l2 * trial * trial).sum(axis=1) / 2


def _steps(chosen: Sequence[int], trial: np.ndarray, bound: np.ndarray, l1: np.ndarray, l2: np.ndarray):
    """Per fit the value reached at ``trial`` and, unless that is above ``bound``, the step from there."""
    place = {fit: i for i, fit in enumerate(chosen)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for added in _added(batches):
            fits = added.column("fit").to_pylist()
            at = [place[f] for f in fits]
            sums = np.array([np.frombuffer(v) for v in added.column("sums").to_pylist()])
            size, total = trial.shape[1], sums[:, :1]
            reached = _reached(sums, trial[at], l1[at], l2[at])
            step = np.zeros((len(at), size))
            fine = ~(reached > bound[at])
            if fine.any():
                gradient, curvature = sums[:, 2 : 2 + size] / total, (sums[:, 2 + size :] / total).reshape(-1, size, size)
                mine = np.array(at)[fine]
                step[fine] = _descended(trial[mine], gradient[fine], curvature[fine], l1[mine], l2[mine])
            found = np.column_stack([reached, step])
            yield pa.RecordBatch.from_arrays(
                [pa.array(fits, pa.int32()), pa.array([f.tobytes() for f in found], pa.binary())], ["fit", "sums"]
            )

    return run


def fit_all(blocks: DataFrame, size: int, weights: Sequence[str], penalties: Sequence[Penalty]) -> np.ndarray:
    """Coefficients of every penalty, one row each: the intercept, then the features.

    Rows: mean loss weighted by the penalty's weight column. A table without rows
    gives zeros. ``ArithmeticError`` if a fit has not settled after :data:`PASSES`.
    """
    columns = list(weights)
    weight_of = [columns.index(p.weight) for p in penalties]
    result = np.zeros((len(penalties), size + 1))
    moments = _collected(blocks, _moments(len(columns))).get(0)
    if moments is None or not len(penalties):
        return result
    # Steps are taken in standardised features; penalties are on the original ones.
    mean, square = moments[1 : size + 2] / moments[0], moments[size + 2 :] / moments[0]
    scale = np.sqrt(np.maximum(square - mean**2, 0))
    scale[scale <= 1e-12 * np.maximum(np.abs(mean), 1)] = 1.0
    centre, scale[0] = np.where(np.arange(size + 1) == 0, 0.0, mean), 1.0
    free = np.arange(size + 1) > 0
    l1 = np.array([p.strength * p.mix / scale * free for p in penalties])
    l2 = np.array([p.strength * (1 - p.mix) / scale**2 * free for p in penalties])
    at = np.zeros_like(result)
    step = np.zeros_like(result)
    share = np.ones(len(penalties))
    value = np.full(len(penalties), np.inf)
    open_ = np.arange(len(penalties))
    tasks = max(blocks.sparkSession.sparkContext.defaultParallelism, 1)
    for _ in range(PASSES):
        trial = at[open_] + share[open_, None] * step[open_]
        # Above its bound a fit is worse than before and its step is halved, as often as that is allowed.
        halved = share[open_] > 0.5**HALVINGS
        with np.errstate(invalid="ignore"):
            bound = np.where(halved, value[open_] + 1e-12 * np.abs(value[open_]), np.inf)
        chosen = open_.tolist()
        found = _collected(
            blocks, _sums(chosen, [weight_of[f] for f in open_], len(columns), trial, centre, scale),
            _steps(chosen, trial, bound, l1[open_], l2[open_]), min(len(chosen), tasks),
        )
        answers = np.array([found[f] for f in chosen])
        reached, worse = answers[:, 0], answers[:, 0] > bound
        share[open_[worse]] /= 2
        fine = open_[~worse]
        # A full Newton step that gains nothing is at the minimum, also where several points share it.
        still = (share[open_] == 1.0) & (value[open_] - reached <= 1e-13 * np.abs(reached))
        at[fine], value[fine], share[fine] = trial[~worse], reached[~worse], 1.0
        step[fine] = answers[~worse, 1:]
        settled = still | (np.abs(step[open_]).max(axis=1) <= TOLERANCE)
        open_ = open_[worse | ~settled]
        if not len(open_):
            result[:, 1:] = at[:, 1:] / scale[1:]
            result[:, 0] = at[:, 0] - result[:, 1:] @ centre[1:]
            return result
    raise ArithmeticError(f"{len(open_)} of {len(penalties)} logistic fits have not settled")


def with_margins(df: DataFrame, coefficients: np.ndarray, label: str = "label", features: str = "features") -> DataFrame:
    """(label, margins): the margins of all fits for every row, computed by blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            found = np.ascontiguousarray(x @ coefficients[:, 1:].T + coefficients[:, 0])
            offsets = pa.array(np.arange(0, found.size + 1, max(found.shape[1], 1), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.ListArray.from_arrays(offsets, pa.array(found.reshape(-1)))], ["label", "margins"]
            )

    rows = df.select(F.col(label).cast("double").alias("label"), vector_to_array(features).alias("x"))
    return rows.mapInArrow(run, "label double, margins array<double>")


def _area_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per fit, over the sorted scores of one range partition: positives, negatives, and wins among them."""
    parts: dict[int, list[float]] = {}
    for batch in batches:
        fits = batch.column("fit").to_numpy(zero_copy_only=False)
        for fit in np.unique(fits).tolist():
            mine = fits == fit
            pos, neg = (batch.column(c).to_numpy(zero_copy_only=False)[mine].astype(np.float64) for c in ("pos", "neg"))
            part = parts.setdefault(fit, [0.0, 0.0, 0.0])
            part[2] += float(pos @ (part[1] + np.cumsum(neg) - neg / 2))
            part[0] += float(pos.sum())
            part[1] += float(neg.sum())
    if parts:
        place = TaskContext.get().partitionId()
        columns = [[place] * len(parts), list(parts), *map(list, zip(*parts.values()))]
        types = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["place", "fit", "pos", "neg", "wins"]
        )


def areas(scored: DataFrame, fits: int) -> list[float]:
    """Exact areas under the ROC curves of all fits of :func:`with_margins`; equal scores count half.

    Scores are range-partitioned by fit and value; a partition returns three sums
    per fit, and those are carried from partition to partition. 0 without both classes.
    """
    rows = scored.where(F.col("label").isNotNull()).select("label", F.posexplode("margins").alias("fit", "score"))
    positive = (F.col("label") == 1).cast("long")
    return areas_by_fit(rows.select("fit", "score", positive.alias("pos"), (1 - positive).alias("neg")), fits)


def areas_by_fit(scored: DataFrame, fits: int, lone: float = 0.0) -> list[float]:
    """The same from rows (fit, score, pos, neg): how many positives and negatives have a score.

    ``lone`` is the area where there are positives alone.
    """
    counted = scored.groupBy("fit", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    parts = (
        counted.repartitionByRange("fit", "score")
        .sortWithinPartitions("fit", "score")
        .mapInArrow(_area_parts, "place int, fit int, pos double, neg double, wins double")
        .collect()
    )
    result = []
    for fit in range(fits):
        positives = negatives = wins = 0.0
        for part in sorted((p for p in parts if p["fit"] == fit), key=lambda p: p["place"]):
            wins += part["wins"] + part["pos"] * negatives
            positives, negatives = positives + part["pos"], negatives + part["neg"]
        result.append(wins / (positives * negatives) if positives and negatives else lone if positives else 0.0)
    return result
