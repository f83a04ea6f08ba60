"""Random forests grown level by level over coded blocks of rows.

A pass serves one level of all trees: a task walks every row of a block down every
tree that drew it and counts, per open node, the classes by bin of the features drawn
there. Counts are kept for the bins above the lowest only (most indicators are 0), and
rows that a tree did not draw are not walked. Counts are added up and the splits
chosen in tasks; the driver gets one split per node. Where a level's counts are too
many for a task, its trees take turns. The method is that of MLlib's
``RandomForestClassifier`` (Poisson draws of rows, features drawn per node, Gini gain on
weighted classes, least rows a child, 32 bins a number); the draws are others, so a
forest is another sample of the same distribution.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, exp, factorial, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stayline.operators.boosting import BINS, Layout, Prepared, decoded, score_counts, SCORE_SCHEMA
from stayline.operators.logistic import areas_by_fit

#: Features at most: a block's rows are expanded to a byte each. Wider tables are for one-by-one fits.
WIDEST = 8_192
#: Trees that a task walks at a time.
TREES = 16
#: Bytes of one task's counts; a level with more takes several passes.
COUNT_BYTES = 128 << 20


@dataclass(frozen=True)
class Setting:
    trees: int
    depth: int
    least: int
    subset: str
    balanced: bool
    seed: int


@dataclass
class Forest:
    """All nodes of all trees, roots first: feature and bin asked for, left child (-1: a leaf; the right one follows), share of class 1."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    share: np.ndarray

    @classmethod
    def of(cls, trees: int) -> Forest:
        return cls(np.zeros(trees, np.int64), np.zeros(trees, np.uint8), np.full(trees, -1), np.zeros(trees))

    def add(self, nodes: int) -> int:
        first = len(self.left)
        self.feature = np.append(self.feature, np.zeros(nodes, np.int64))
        self.bin = np.append(self.bin, np.zeros(nodes, np.uint8))
        self.left = np.append(self.left, np.full(nodes, -1))
        self.share = np.append(self.share, np.zeros(nodes))
        return first


    def prune(self) -> None:
        """Sibling leaves of the same class become one leaf with the share of their parent, as in MLlib."""
        while True:
            inner = np.flatnonzero(self.left >= 0)
            pair = self.left[inner][:, None] + [0, 1]
            votes = self.share[pair] > 0.5
            alike = (self.left[pair] < 0).all(axis=1) & (votes[:, 0] == votes[:, 1])
            if not alike.any():
                return
            self.left[inner[alike]] = -1


# Cumulated Poisson(1) in steps of 2^-16: a draw is a look-up.
_EDGES = np.cumsum([exp(-1) / factorial(k) for k in range(9)])
_DRAWS = np.searchsorted(_EDGES, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


#: How many features a node draws, as MLlib counts them.
SUBSETS = {"all": lambda n: n, "sqrt": lambda n: ceil(sqrt(n)), "log2": lambda n: max(1, ceil(log2(n))), "onethird": lambda n: ceil(n / 3)}


def _matrix(layout: Layout, codes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Bins of the numbers, then one indicator per category; a row of bytes per row."""
    rows = codes.shape[1]
    wide = np.zeros((rows, layout.numbers + layout.width - BINS * layout.numbers), np.uint8)
    wide[:, : layout.numbers] = bins.T
    at = layout.starts[:-1, None] - BINS * layout.numbers + layout.numbers + codes
    np.put_along_axis(wide, at.T, 1, axis=1)
    return wide


def _slots(layout: Layout) -> np.ndarray:
    """Counted bins of every feature: all but the lowest."""
    return np.r_[np.full(layout.numbers, BINS - 1), np.ones(layout.width - BINS * layout.numbers, int)]


def _walked(wide, base, node, carried, forest: Forest, steps: int):
    """Pairs of row and tree that are still inside the tree after ``steps`` steps."""
    flat = wide.reshape(-1)
    for _ in range(steps):
        left = forest.left[node]
        live = left >= 0
        if not live.all():
            base, node, left, carried = base[live], node[live], left[live], [c[live] for c in carried]
        node = left + (flat[base + forest.feature[node]] > forest.bin[node])
    return base, node, carried


def _counts(layout: Layout, fold: int, forest: Forest, setting: Setting, level: int, slot: np.ndarray, chunks: Sequence[tuple]):
    """Per chunk of trees the class counts of its open nodes: totals, then by counted bin of the drawn features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(c[3], np.int64) for c in chunks]
        seen = False
        for number, (codes, bins, sides, folds, _) in decoded(batches, layout):
            wide, classes, train = _matrix(layout, codes, bins[fold]), (sides > 0).astype(np.int64), folds != fold
            flat, features = wide.reshape(-1), wide.shape[1]
            seen = True
            for (trees, drawn, starts, size), total in zip(chunks, totals):
                draws = _DRAWS[_generator(setting.seed, number, trees).integers(0, 1 << 16, (len(sides), len(trees)), np.uint16)]
                row, tree = np.nonzero(draws * train[:, None])
                carried = [draws[row, tree].astype(np.float64), classes[row]]
                base, node, (weight, label) = _walked(wide, row * features, np.asarray(trees)[tree], carried, forest, level)
                place = slot[node]
                if not (place >= 0).all():
                    keep = place >= 0
                    base, place, weight, label = base[keep], place[keep], weight[keep], label[keep]
                nodes, width = drawn.shape
                total[: 2 * nodes] += np.bincount(2 * place + label, weight, 2 * nodes).astype(np.int64)
                value = flat[base[:, None] + drawn[place]].reshape(-1)
                hit = np.flatnonzero(value)
                pair = hit // width
                at = starts.reshape(-1)[place[pair] * width + hit - pair * width]
                at += 2 * (value[hit].astype(np.int64) - 1) + label[pair]
                total += np.bincount(at, weight[pair], size).astype(np.int64)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(chunks)), pa.int32()), pa.array([t.tobytes() for t in totals], pa.binary())], ["chunk", "counts"]
            )

    return run


def _generator(seed: int, block: int, trees: Sequence[int]) -> np.random.Generator:
    return np.random.Generator(np.random.SFC64([seed, block, trees[0]]))


def _splits(layout: Layout, fold: int, chunks: Sequence[tuple], weights: np.ndarray, least: int):
    """Per open node: totals of both classes, the chosen feature (-1: none), its bin, and the classes going left."""
    slots = _slots(layout)
    cuts = np.r_[[len(t) for t in layout.thresholds[fold]], np.ones(layout.width - BINS * layout.numbers)].astype(int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(counts, np.int64)
                added[chunk] = added[chunk] + values if chunk in added else values
        for chunk, counts in added.items():
            _, drawn, starts, _ = chunks[chunk]
            nodes = len(drawn)
            total = counts[: 2 * nodes].reshape(nodes, 2).astype(float)
            result = np.column_stack([total, np.full(nodes, -1.0), np.zeros((nodes, 3))])
            best = np.zeros(nodes)
            for s in range(drawn.shape[1]):
                mine, asked = np.full(nodes, -np.inf), np.zeros((nodes, 3))
                right = np.zeros((nodes, 2))
                # From the highest bin down: the rows above bin ``k`` go right, the lowest of equal bins wins.
                for k in range(int(slots[drawn[:, s]].max()) - 1, -1, -1):
                    own = np.flatnonzero(k < slots[drawn[:, s]])
                    at = starts[own, s] + 2 * k
                    right[own] += np.column_stack([counts[at], counts[at + 1]])
                    own = own[k < cuts[drawn[own, s]]]
                    left = total[own] - right[own]
                    gain = _gain(total[own], left, right[own], weights, least)
                    better = gain >= mine[own]
                    chosen = own[better]
                    mine[chosen] = gain[better]
                    asked[chosen] = np.column_stack([np.full(len(chosen), k), left[better]])
                better = mine > best
                best[better] = mine[better]
                result[better, 2], result[better, 3:] = drawn[better, s], asked[better]
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([result.tobytes()], pa.binary())], ["chunk", "counts"])

    return run


def _gain(total, left, right, weights, least) -> np.ndarray:
    def impurity(counts):
        weighted = counts * weights
        size = weighted.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return size, 1 - np.square(weighted / size[:, None]).sum(axis=1)

    (n, own), (nl, a), (nr, b) = impurity(total), impurity(left), impurity(right)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = own - nl / n * a - nr / n * b
    return np.where((left.sum(axis=1) >= max(least, 1)) & (right.sum(axis=1) >= max(least, 1)), gain, -np.inf)


def _chunked(forest: Forest, trees: Sequence[tuple], layout: Layout, usable: np.ndarray, size: int, random) -> tuple[np.ndarray, list[tuple]]:
    """Every open node's place in its chunk of trees; per chunk the features drawn and where the counts of each lie."""
    slots, chunks = _slots(layout), []
    slot = np.full(len(forest.left), -1, np.int32)
    for at in range(0, len(trees), TREES):
        part = trees[at : at + TREES]
        nodes = np.concatenate([own for _, own in part])
        slot[nodes] = np.arange(len(nodes))
        drawn = usable[np.sort(random.random((len(nodes), len(usable)), np.float32).argpartition(size - 1, axis=1)[:, :size], axis=1)]
        spaces = 2 * slots[drawn].reshape(-1)
        ends = np.cumsum(spaces)
        starts = (2 * len(nodes) + ends - spaces).reshape(drawn.shape)
        chunks.append(([t for t, _ in part], drawn, starts, int(2 * len(nodes) + ends[-1])))
    return slot, chunks


def _turns(open_: Sequence[tuple], size: int) -> Iterator[list[tuple]]:
    """Trees with open nodes in turns whose counts fit into a task; a node's are taken at their largest."""
    turn, bytes_ = [], 0
    for tree, nodes in open_:
        own = len(nodes) * 8 * (2 + 2 * size * 4)
        if turn and bytes_ + own > COUNT_BYTES and len(turn) % TREES == 0:
            yield turn
            turn, bytes_ = [], 0
        turn.append((tree, nodes))
        bytes_ += own
    if turn:
        yield turn


def class_counts(data: Prepared) -> np.ndarray:
    """Rows by fold, class and feature (its categories only), the last place counting all rows."""
    layout = data.layout
    folds, width = len(layout.thresholds), layout.width - BINS * layout.numbers
    starts = layout.starts[:-1, None] - BINS * layout.numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((folds, 2, width + 1), np.int64)
        for _, (codes, _, sides, own, _) in decoded(batches, layout):
            for f in range(folds):
                for c in (0, 1):
                    mine = (own == f) & ((sides > 0) == c)
                    found[f, c, :width] += np.bincount((codes[:, mine] + starts).reshape(-1), minlength=width)
                    found[f, c, width] += mine.sum()
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["counts"])

    rows = data.blocks.mapInArrow(run, "counts binary").toArrow().column("counts").to_pylist()
    return sum(np.frombuffer(r, np.int64).reshape(folds, 2, width + 1) for r in rows)


def grow(data: Prepared, counts: np.ndarray, fold: int, setting: Setting) -> Forest:
    """The forest of one setting, grown on all rows but those of ``fold``."""
    layout, blocks = data.layout, data.blocks
    train = np.delete(counts, fold, axis=0).sum(axis=0)
    present = train[:, :-1].sum(axis=0) > 0
    usable = np.r_[np.arange(layout.numbers), layout.numbers + np.flatnonzero(present)]
    size = min(len(usable), SUBSETS[setting.subset](len(usable)))
    rows = train[:, -1]
    weights = rows.sum() / (2.0 * np.maximum(rows, 1)) if setting.balanced else np.ones(2)
    forest = Forest.of(setting.trees)
    tasks = max(blocks.sparkSession.sparkContext.defaultParallelism, 1)
    open_ = [(t, np.array([t])) for t in range(setting.trees)]
    for level in range(setting.depth):
        random = np.random.default_rng([setting.seed, level])
        later = []
        for turn in _turns(open_, size):
            slot, chunks = _chunked(forest, turn, layout, usable, size, random)
            partial = blocks.mapInArrow(_counts(layout, fold, forest, setting, level, slot, chunks), "chunk int, counts binary")
            merged = partial.repartition(min(tasks, len(chunks)), "chunk")
            found = merged.mapInArrow(_splits(layout, fold, chunks, weights, setting.least), "chunk int, counts binary").toArrow()
            splits = dict(zip(found.column("chunk").to_pylist(), found.column("counts").to_pylist()))
            for k in range(len(chunks)):
                own = turn[k * TREES : (k + 1) * TREES]
                answer = np.frombuffer(splits[k]).reshape(-1, 6)
                later.append((own, answer))
        open_ = []
        for own, answer in later:
            nodes = np.concatenate([n for _, n in own])
            trees = np.repeat([t for t, _ in own], [len(n) for _, n in own])
            weighted = answer[:, :2] * weights
            if not level:
                forest.share[nodes] = weighted[:, 1] / np.maximum(weighted.sum(axis=1), 1e-300)
            split = answer[:, 2] >= 0
            first = forest.add(2 * int(split.sum()))
            parents = nodes[split]
            forest.feature[parents], forest.bin[parents] = answer[split, 2].astype(int), answer[split, 3].astype(np.uint8)
            forest.left[parents] = first + 2 * np.arange(len(parents))
            left = answer[split, 4:6]
            going = np.stack([left, answer[split, :2] - left], axis=1).reshape(-1, 2)
            weighted = going * weights
            forest.share[first:] = weighted[:, 1] / weighted.sum(axis=1)
            mixed = (going > 0).all(axis=1)
            children, owners = first + np.arange(len(going)), np.repeat(trees[split], 2)
            open_ += [(t, mine) for t, _ in own if len(mine := children[mixed & (owners == t)])]
        if not open_:
            break
    forest.prune()
    return forest


def _probabilities(layout: Layout, fold: int, forest: Forest, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (codes, bins, sides, folds, _) in decoded(batches, layout):
            held = np.flatnonzero(folds == fold)
            if not len(held):
                continue
            wide = _matrix(layout, codes[:, held], bins[fold][:, held])
            flat, base, total = wide.reshape(-1), np.arange(len(held)) * wide.shape[1], np.zeros(len(held))
            for tree in range(trees):
                node = np.full(len(held), tree)
                moving = np.arange(len(held))
                while len(moving := moving[forest.left[node[moving]] >= 0]):
                    now = node[moving]
                    node[moving] = forest.left[now] + (flat[base[moving] + forest.feature[now]] > forest.bin[now])
                total += forest.share[node]
            yield score_counts(np.zeros(len(held)), total / trees, sides[held] > 0)

    return run


def fold_score(data: Prepared, counts: np.ndarray, fold: int, setting: Setting) -> float:
    """Area under the ROC curve of the rows of ``fold``, scored by the forest grown without them."""
    forest = grow(data, counts, fold, setting)
    scored: DataFrame = data.blocks.mapInArrow(_probabilities(data.layout, fold, forest, setting.trees), SCORE_SCHEMA)
    return areas_by_fit(scored, 1, 1.0)[0]
