"""One boosted-tree setting over all folds of a table, fitted together.

Boosting is a chain: every level of every tree is a pass over the rows. Fitted one
by one, five folds walk that chain five times over expanded one-hot vectors. Here a
pass serves all folds at once and reads the categories as codes: a task returns, per
fold and open node, counts and sums of residuals by bin or category (nothing that
grows with the rows), and the driver picks the splits. The trees are those of MLlib's
``GBTClassifier``: residuals of its log loss, variance gain, at most 32 bins a number
between thresholds found on about 10,000 rows, one indicator per category.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, functions as F

from stayline.operators.features import MISSING_CATEGORY
from stayline.operators.logistic import areas_by_fit
from stayline.session import settle_worker, staged

#: Rows of a block; bins of a number and rows that its thresholds are found on, as in MLlib.
BLOCK_ROWS, BINS, SPLIT_ROWS = 4_096, 32, 10_000
#: Rows of a pass's task at least: with fewer, starting the task costs more than its counting.
TASK_ROWS = 24_576
#: Rounds between two written states: the lineage of the cached ones stays short.
WRITTEN_EVERY = 20
#: Bytes of one task's histograms. Wider tables are for one-by-one fits.
HISTOGRAM_BYTES = 32 << 20


@dataclass(frozen=True)
class Layout:
    """Where each column's bins lie: numbers first, ``BINS`` each, then one bin per category."""

    numbers: int
    categories: list[list[str]]
    thresholds: list[list[np.ndarray]]  # by fold and number

    @property
    def starts(self) -> np.ndarray:
        """First bin of every categorical column, and the end."""
        return BINS * self.numbers + np.cumsum([0, *map(len, self.categories)])

    @property
    def width(self) -> int:
        return int(self.starts[-1])

    @property
    def code_type(self) -> type:
        """What a category's code is stored as: every pass moves all codes."""
        return np.uint8 if max(map(len, self.categories), default=0) <= 256 else np.int32

    def fits_in_driver(self, depth: int) -> bool:
        return len(self.thresholds) * 2 ** (depth - 1) * self.width * 16 <= HISTOGRAM_BYTES


@dataclass(frozen=True)
class Prepared:
    """Blocks of rows as a written table, their layout, and how many rows they hold."""

    blocks: DataFrame
    layout: Layout
    rows: int


@dataclass
class Tree:
    """A binary tree as a heap: the column and bin that a node asks for (column -1: a leaf), and its mean."""

    column: np.ndarray
    bin: np.ndarray
    mean: np.ndarray = field(repr=False)

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size))


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` thresholds between distinct values, about equally many rows apart (MLlib's rule)."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= bins - 1:
        return middles
    stride = len(values) / bins
    found, reached, target = [], counts[0], stride
    for i in range(1, len(distinct)):
        before, reached = reached, reached + counts[i]
        if abs(before - target) < abs(reached - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def _blocks(layout: Layout, numbers: Sequence[str], texts: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [pa.array(c, pa.string()) for c in layout.categories]
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                values = [part.column(c).to_numpy(zero_copy_only=False) for c in numbers]
                if not all(np.isfinite(v).all() for v in values):
                    raise ValueError("boosting needs numbers without null, NaN and infinity")
                bins = np.array([[np.searchsorted(t, v) for t, v in zip(own, values)] for own in layout.thresholds], np.uint8)
                codes = np.array(
                    [pc.index_in(part.column(c), value_set=k).to_numpy(zero_copy_only=False) for c, k in zip(texts, known)], layout.code_type
                )
                own = [part.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold")]
                sides = np.where(own[0] == 1, 1, -1).astype(np.int8)
                margins = np.zeros((len(layout.thresholds), part.num_rows))
                stored = (codes, bins, sides, own[1].astype(np.int32), margins)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([part.num_rows]), *[pa.array([np.ascontiguousarray(s).tobytes()], pa.binary()) for s in stored]], _STORED
                )
                number += 1

    return run


_STORED = ["number", "rows", "codes", "bins", "sides", "fold", "margins"]
_STORED_SCHEMA = "number long, rows long, codes binary, bins binary, sides binary, fold binary, margins binary"


def prepare(rows: DataFrame, folds: int, categorical: Sequence[str], numeric: Sequence[str]) -> Prepared:
    """Coded blocks of labelled rows with a ``fold``; thresholds are found for each fold without its own rows."""
    names = [f"_t{i}" for i in range(len(categorical))]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)).alias(n) for c, n in zip(categorical, names)]
    numbers = [F.col(c).cast("double").alias(f"_n{i}") for i, c in enumerate(numeric)]
    coded = rows.select(*texts, *numbers, F.col("label").cast("double").alias("label"), F.col("fold").cast("int").alias("fold"))
    found = coded.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("label").alias("labelled"),
        *[F.sort_array(F.collect_set(n)).alias(n) for n in names],
        *[F.count(F.when(F.col("fold") != i, 1)).alias(f"train{i}") for i in range(folds)],
    ).first()
    if found["labelled"] < found["n"]:
        raise ValueError("boosting needs a label in every row")
    if not all(found[f"train{i}"] for i in range(folds)):
        raise ValueError("boosting needs rows to train on in every fold")
    least = min(found[f"train{i}"] for i in range(folds))
    chosen = coded if least <= SPLIT_ROWS else coded.sample(False, min(1.0, SPLIT_ROWS / least), 42)
    sample = chosen.select("fold", *[f"_n{i}" for i in range(len(numeric))]).toArrow()
    of = sample.column("fold").to_numpy()
    values = [sample.column(f"_n{j}").to_numpy() for j in range(len(numeric))]
    cuts = [[thresholds(v[of != i], min(BINS, found[f"train{i}"])) for v in values] for i in range(folds)]
    layout = Layout(len(numeric), [list(found[n]) for n in names], cuts)
    run = _blocks(layout, [f"_n{i}" for i in range(len(numeric))], names)
    return Prepared(staged(coded.mapInArrow(run, _STORED_SCHEMA), "boosting"), layout, found["n"])


def _block(row, layout: Layout) -> tuple:
    n, folds = row["rows"], len(layout.thresholds)
    return (
        np.frombuffer(row["codes"], layout.code_type).reshape(len(layout.categories), n),
        np.frombuffer(row["bins"], np.uint8).reshape(folds, layout.numbers, n),
        np.frombuffer(row["sides"], np.int8),
        np.frombuffer(row["fold"], np.int32),
        np.frombuffer(row["margins"]).reshape(folds, n),
    )


def decoded(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[tuple[int, tuple]]:
    """Number and arrays of every block: codes, bins by fold, sides (1 or -1), folds, margins."""
    settle_worker()
    for batch in batches:
        for row in batch.to_pylist():
            yield row["number"], _block(row, layout)


def _nodes(tree: Tree, numbers: int, codes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The node of every row; a number above its bin, and a row of the category, go right."""
    node = np.zeros(codes.shape[-1], np.int64)
    for i in np.flatnonzero(tree.column >= 0):
        column = tree.column[i]
        right = bins[column] > tree.bin[i] if column < numbers else codes[column - numbers] == tree.bin[i]
        node = np.where(node == i, 2 * i + 1 + right, node)
    return node


def _histograms(layout: Layout, trees: Sequence[Tree], level: int, first: bool, counted: bool):
    """Per fold and node of ``level``: rows (if ``counted``) and residuals, by bin."""
    numbers, starts, width, nodes = layout.numbers, layout.starts, layout.width, 2**level

    def run(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        settle_worker()
        totals = np.zeros((2, len(trees), nodes * width))
        for codes, bins, sides, fold, margins in blocks:
            at = np.empty((len(sides), numbers + len(codes)), np.int64)
            based = codes.T + starts[:-1]
            for f, tree in enumerate(trees):
                node = _nodes(tree, numbers, codes, bins[f]) - (nodes - 1)
                mine = (fold != f) & (node >= 0)
                residual = sides if first else 4 * sides / (1 + np.exp(np.minimum(2 * sides * margins[f], 700)))
                base = np.where(mine, node, 0)[:, None] * width
                at[:, :numbers] = bins[f].T + (np.arange(numbers) * BINS + base)
                at[:, numbers:] = based + base
                flat = at.reshape(-1)
                for k, weight in ((0, mine), (1, residual * mine)):
                    if k or counted:
                        spread = np.repeat(weight.astype(np.float64), at.shape[1])
                        totals[k, f] += np.bincount(flat, spread, minlength=nodes * width)
        yield totals.reshape(2, len(trees), nodes, width)

    return run


def _grow(tree: Tree, layout: Layout, fold: int, level: int, counts: np.ndarray, sums: np.ndarray, least: int) -> None:
    """Splits the nodes of a level where variance falls most; the first of equal gains wins."""
    cuts = [len(t) for t in layout.thresholds[fold]]
    columns = np.repeat(np.arange(layout.numbers + len(layout.categories)), [*cuts, *map(len, layout.categories)])
    asked = np.concatenate([np.arange(k) for k in (*cuts, *map(len, layout.categories))])
    start = 2**level - 1
    for k in range(2**level):
        i = start + k
        if level and tree.column[(i - 1) // 2] < 0:
            continue
        own = slice(0, BINS) if layout.numbers else slice(0, len(layout.categories[0]))
        n, s = counts[k, own].sum(), sums[k, own].sum()
        if not level:
            tree.mean[i] = s / n
        right = []
        for values, total in ((counts[k], n), (sums[k], s)):
            lefts = [np.cumsum(values[j * BINS : j * BINS + c]) for j, c in enumerate(cuts)]
            right.append(np.concatenate([*[total - v for v in lefts], values[BINS * layout.numbers :]]))
        if not len(columns):
            continue
        (nr, sr), (nl, sl) = right, (n - right[0], s - right[1])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (sl * sl / nl + sr * sr / nr - s * s / n) / n
        gain = np.where((nl >= least) & (nr >= least) & (nl > 0) & (nr > 0), gain, -np.inf)
        best = int(np.argmax(gain))
        if gain[best] > 0:
            tree.column[i], tree.bin[i] = columns[best], asked[best]
            tree.mean[2 * i + 1], tree.mean[2 * i + 2] = sl[best] / nl[best], sr[best] / nr[best]


def _advanced(layout: Layout, trees: Sequence[Tree], weight: float):
    def run(block: tuple) -> tuple:
        codes, bins, sides, fold, margins = block
        moved = [m + weight * t.mean[_nodes(t, layout.numbers, codes, b)] for t, b, m in zip(trees, bins, margins)]
        return codes, bins, sides, fold, np.array(moved)

    return run


def _stored(block: tuple) -> tuple:
    return (0, len(block[2]), *[bytearray(np.ascontiguousarray(b).tobytes()) for b in block])


def _spread(blocks: DataFrame, layout: Layout, rows: int) -> RDD:
    """The blocks as a cached collection, dealt evenly over all cores, or fewer where rows are few."""
    tasks = min(blocks.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return blocks.repartition(max(tasks, 1)).rdd.map(lambda row: _block(row, layout)).persist(StorageLevel.MEMORY_AND_DISK)


def margins(data: Prepared, rounds: int, depth: int, rate: float, least: int) -> RDD:
    """Cached blocks whose last array has, per fold and row, the margin of the model fitted without that fold's rows."""
    layout, spark = data.layout, data.blocks.sparkSession
    folds = range(len(layout.thresholds))
    state, held, known = _spread(data.blocks, layout, data.rows), [], None
    for turn in range(rounds):
        trees = [Tree.empty(depth) for _ in folds]
        for level in range(depth):
            counted = bool(level) or known is None
            found = sum(state.mapPartitions(_histograms(layout, trees, level, not turn, counted)).collect())
            if not level:  # the root's counts are the same in every round
                known = found[0] if known is None else known
                found[0] = known
            for f, tree in enumerate(trees):
                _grow(tree, layout, f, level, found[0][f], found[1][f], least)
            for old in held:
                old.unpersist()
            held = []
            if all((t.column[2**level - 1 : 2 ** (level + 1) - 1] < 0).all() for t in trees):
                break
        held.append(state)
        state = state.map(_advanced(layout, trees, rate if turn else 1.0)).persist(StorageLevel.MEMORY_AND_DISK)
        if turn % WRITTEN_EVERY == WRITTEN_EVERY - 1 and turn < rounds - 1:
            held.append(state)
            state = _spread(staged(spark.createDataFrame(state.map(_stored), _STORED_SCHEMA), "boosted"), layout, data.rows)
    state.count()
    for old in held:
        old.unpersist()
    return state


SCORE_SCHEMA = "fit int, score double, pos long, neg long"


def score_counts(fit: np.ndarray, score: np.ndarray, positive: np.ndarray) -> pa.RecordBatch:
    """(fit, score, pos, neg) of a block, counted by score already: what is shuffled shrinks with ties."""
    found, which = np.unique(np.column_stack([fit, score]), axis=0, return_inverse=True)
    pos, neg = (np.bincount(which.reshape(-1), side, len(found)).astype(np.int64) for side in (positive, ~positive))
    return pa.RecordBatch.from_arrays(
        [pa.array(found[:, 0].astype(np.int32)), pa.array(found[:, 1]), pa.array(pos), pa.array(neg)], ["fit", "score", "pos", "neg"]
    )


def _held_out(block: tuple) -> list[tuple]:
    _, _, sides, fold, margin = block
    rows = np.flatnonzero((fold >= 0) & (fold < len(margin)))
    own = margin[fold[rows], rows]
    counted = score_counts(fold[rows], 1 / (1 + np.exp(np.minimum(-2 * own, 700))), sides[rows] > 0)
    return list(zip(*[column.to_pylist() for column in counted.columns]))


def fold_scores(data: Prepared, rounds: int, depth: int, rate: float, least: int) -> list[float]:
    """Areas under the ROC curves, each fold's rows scored by the model fitted without them."""
    state = margins(data, rounds, depth, rate, least)
    try:
        spark = data.blocks.sparkSession
        counted = spark.createDataFrame(state.flatMap(_held_out), SCORE_SCHEMA)
        return areas_by_fit(counted, len(data.layout.thresholds), 1.0)  # as MLlib's curve ends
    finally:
        state.unpersist()
