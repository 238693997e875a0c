"""Gradient boosting on histograms, trees grown leaf by leaf, with missing values routed.

Feature values become bin codes at the medians between distinct values, or at quantiles where
there are more values than bins; NULL and NaN have a bin of their own. Gradients depend on a row's
codes and label only, so rows with equal codes are first added up to one row with two counts,
and boosting works on these exactly as it would on all rows.

A tree grows best first: of all leaves the one whose best split gains most is split next. One
pass over the rows adds up the gradient histograms of the children of every leaf that may come
next, the smaller child's only, the other being the difference to the parent's. Whoever grows the
tree keeps histograms of open leaves, whose size depends on bins and features, not on rows, and
replays the queue until a leaf without known children comes first.

Rows lie in blocks of about ``ROWS_PER_BLOCK``, a few numpy arrays each. With several, a pass is a
job that adds up the histograms of all blocks, and trees grow on the driver; blocks stay in memory,
margins are worked out from the trees so far, so a lost block needs no lineage but the staged rows. A
single block needs nothing from others, so all passes run in its task, as one job. Both ways grow
the same trees.

For a split on a feature with missing values both directions are tried; without any, missing
values go to the side with more rows, should they turn up later.
"""

from __future__ import annotations

import heapq
import math
import pickle
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import stage

ROWS_PER_BLOCK = 200_000  # of rows with different codes
KEEP_EVERY = 10  # rounds after which margins are kept anew
DIRECT = 32  # partitions whose histograms are added on the driver; more are added in a tree
LEAST_HESSIAN = 1e-3
CLOSE = 1e-9  # gains that differ by less, relatively, are ties
PATIENCE = 10
HELD_OUT = 0.1
STOP_EARLY_FROM = 10_000  # rows from which a part is held out to stop early
TOLERANCE = 1e-7


@dataclass
class Node:
    """A leaf, or the split ``code <= bin`` of ``feature``."""

    n: int
    value: float
    feature: int = -1
    bin: int = -1
    missing_left: bool = False
    gain: float = 0.0
    left: int = -1
    right: int = -1


@dataclass
class Forest:
    """Trees over bin codes; ``edges`` holds the cuts of every feature, in the order of ``features``."""

    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[list[Node]] = field(default_factory=list)


# --- bins ---------------------------------------------------------------------


def feature_edges(rows: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Cuts between neighbouring values, or between quantiles of features with many values."""
    values = F.explode(
        F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).cast("double").alias("v")) for i, f in enumerate(features)])
    )
    known = rows.select(values.alias("x")).select("x.*").where("v IS NOT NULL AND NOT isnan(v)")
    distinct = stage(known.distinct(), "values")
    counts = {r["f"]: r["n"] for r in distinct.groupBy("f").agg(F.count("*").alias("n")).collect()}
    few = [f for f, n in counts.items() if n <= bins]
    found: dict[int, list[float]] = {}
    if few:  # at most ``bins`` values of each
        for r in distinct.where(F.col("f").isin(few)).collect():
            found.setdefault(r["f"], []).append(r["v"])
    many = sorted(counts.keys() - set(few))
    if many:
        points = [k / bins for k in range(1, bins)]
        cuts = rows.agg(*[F.percentile_approx(F.col(features[f]).cast("double"), points, 20_000).alias(str(f)) for f in many]).first()
        found |= {f: list(cuts[str(f)]) for f in many}
    out = []
    for f in range(len(features)):
        values = sorted(set(found.get(f, [])))
        out.append([a + (b - a) / 2 for a, b in zip(values, values[1:])])
    return out


def with_codes(rows: DataFrame, features: list[str], edges: list[list[float]], prefix: str) -> DataFrame:
    """``rows`` with the bin of each feature: the number of cuts below it, one more than all
    of them for a missing value."""
    doubles, codes = [f"{prefix}v{i}" for i in range(len(features))], [f"{prefix}{i}" for i in range(len(features))]
    missing = F.lit(math.nan)  # the bucketizer keeps NaN, but not NULL
    cast = rows.withColumns({d: F.coalesce(F.col(f).cast("double"), missing) for d, f in zip(doubles, features)})
    splits = [[-math.inf, *cuts, math.inf] if cuts else [-math.inf, 0.0, math.inf] for cuts in edges]
    binned = Bucketizer(splitsArray=splits, inputCols=doubles, outputCols=codes, handleInvalid="keep").transform(cast)

    def code(i: int) -> Column:
        if edges[i]:
            return F.col(codes[i]).cast("int")
        return F.when(F.col(codes[i]) == 2, 1).otherwise(0)

    return binned.withColumns({codes[i]: code(i) for i in range(len(features))}).drop(*doubles)


# --- blocks of rows ---------------------------------------------------------------


def _blocks(table: DataFrame, sizes: list[int], run) -> DataFrame:
    """``run`` on each partition as a block: codes, where the last bin is that of missing
    values, counts and positives of train and of held-out rows. One binary per block."""
    width, last = len(sizes), max(sizes) - 1

    def packed(batches):
        parts = [b for b in batches if b.num_rows]
        if parts:
            rows = pa.Table.from_batches(parts)
            codes = np.stack([rows[f"c{i}"].to_numpy() for i in range(width)], 1)
            codes = np.where(codes == np.array(sizes) - 1, last, codes).astype(np.uint8)
            counts = [rows[c].to_numpy().astype(np.float64) for c in ("n", "positive", "held_n", "held_positive")]
            yield pa.RecordBatch.from_pydict({"data": pa.array([pickle.dumps(run((codes, *counts)))], pa.binary())})

    return table.mapInArrow(packed, "data binary")


def _walk(codes: np.ndarray, nodes: list[Node], last: int) -> np.ndarray:
    """The node that each row ends at."""
    feature = np.array([n.feature for n in nodes])
    at = np.zeros(len(codes), np.int32)
    if feature[0] < 0:
        return at
    cut, left, right, lost_left = (np.array([getattr(n, k) for n in nodes]) for k in ("bin", "left", "right", "missing_left"))
    inner = np.arange(len(codes))
    while len(inner):
        here = at[inner]
        code = codes[inner, feature[here]]
        down = np.where(code == last, lost_left[here], code <= cut[here])
        at[inner] = np.where(down, left[here], right[here])
        inner = inner[feature[at[inner]] >= 0]
    return at


def _margins(block, base: float, trees: list[list[Node]], last: int, known=None):
    margin = np.full(len(block[0]), base) if known is None else known.copy()
    for nodes in trees:
        margin += np.array([n.value for n in nodes])[_walk(block[0], nodes, last)]
    return margin


def _histograms(block, margin, nodes: list[Node], wanted: list[int], bins: int, loss: bool):
    """``(3, wanted nodes, features, bins)``: gradient, hessian, rows. And the loss on held-out rows."""
    codes, n, positive, held_n, held_positive = block
    p = 1 / (1 + np.exp(-margin))
    slot_of = np.full(len(nodes), -1)
    slot_of[wanted] = np.arange(len(wanted))
    slot = slot_of[_walk(codes, nodes, bins - 1)]
    rows = np.flatnonzero((slot >= 0) & (n > 0))
    width = codes.shape[1]
    place = ((slot[rows] * width)[:, None] + np.arange(width)) * bins + codes[rows]
    weights = (n * p - positive)[rows], (n * p * (1 - p))[rows], n[rows]
    shape = (len(wanted), width, bins)
    out = np.stack(
        [np.bincount(place.ravel(), np.repeat(w, width), math.prod(shape)).reshape(shape) for w in weights]
    )
    lost = float((held_n * np.logaddexp(0, margin) - held_positive * margin).sum()) if loss else 0.0
    return out, lost


class _OneBlock:
    """Passes over a single block, in its task."""

    def __init__(self, block, base: float, bins: int):
        self.block, self.bins, self.done = block, bins, 0
        self.margin = np.full(len(block[0]), base)

    def __call__(self, trees, nodes, wanted, loss=False):
        self.margin = _margins(self.block, 0.0, trees[self.done :], self.bins - 1, self.margin)
        self.done = len(trees)
        return _histograms(self.block, self.margin, nodes, wanted, self.bins, loss)


class _ManyBlocks:
    """Passes over blocks in memory, a job each. Margins are kept anew every few rounds."""

    def __init__(self, table: DataFrame, sizes: list[int], base: float):
        self.base, self.bins, self.done, self.kept, self.before = base, max(sizes), 0, None, None
        packed = _blocks(table, sizes, lambda block: block)
        self.blocks = packed.rdd.map(lambda r: pickle.loads(r["data"])).persist(StorageLevel.MEMORY_AND_DISK)

    def __call__(self, trees, nodes, wanted, loss=False):
        base, bins, every = self.base, self.bins, list(trees)
        if len(every) - self.done >= KEEP_EVERY:
            self.before, self.done = self.kept, len(every)
            self.kept = self.blocks.map(lambda b: _margins(b, base, every, bins - 1)).persist(StorageLevel.MEMORY_AND_DISK)
        recent = every[self.done :]

        def run(element):
            block, known = element
            return _histograms(block, _margins(block, base, recent, bins - 1, known), nodes, wanted, bins, loss)

        state = self.blocks.map(lambda b: (b, None)) if self.kept is None else self.blocks.zip(self.kept)
        found = self._added(state.map(run))
        if self.before is not None:
            self.before.unpersist()
            self.before = None
        return found

    @staticmethod
    def _added(parts):
        def add(a, b):
            return a[0] + b[0], a[1] + b[1]

        if parts.getNumPartitions() > DIRECT:
            return parts.treeReduce(add)
        return reduce(add, parts.collect())

    def close(self) -> None:
        self.blocks.unpersist()
        if self.kept is not None:
            self.kept.unpersist()


# --- trees ----------------------------------------------------------------------


def best_split(hist: np.ndarray, min_leaf: int, l2: float):
    """``(gain, feature, bin, missing_left)`` of the best split of one node, or None. Of equal
    gains the first feature, missing values on the right, and the lowest cut."""
    lost = hist[:, :, None, -1:]
    whole = hist.sum(2)[:, :, None, None]
    below = np.cumsum(hist[:, :, :-1], 2)
    # By feature, direction of missing values and cut. With missing values on the right, all
    # others may be on the left.
    left = np.stack([below, below + hist[:, :, -1:]], 2)
    right = whole - left
    fits = (np.minimum(left[2], right[2]) >= min_leaf) & (np.minimum(left[1], right[1]) >= LEAST_HESSIAN)
    fits[:, 1] &= lost[2, :, 0] > 0
    if not fits.any():
        return None

    def score(x):
        return x[0] ** 2 / (x[1] + l2)

    gains = np.where(fits, score(left) + score(right) - score(whole), -np.inf)
    most = gains.max()
    if most <= 0:
        return None
    feature, direction, cut = np.unravel_index(np.argmax(gains >= most * (1 - CLOSE)), gains.shape)
    if lost[2, feature, 0, 0] > 0:
        missing_left = bool(direction)
    else:
        missing_left = bool(left[2, feature, 0, cut] > right[2, feature, 0, cut])
    return float(gains[feature, direction, cut]), int(feature), int(cut), missing_left


class Tree:
    """A tree that grows best first over the histograms it has got so far."""

    def __init__(self, root: np.ndarray, leaves: int, min_leaf: int, l2: float, rate: float):
        self.leaves, self.min_leaf, self.l2, self.rate = leaves, min_leaf, l2, rate
        self.nodes: list[Node] = []
        self.hist: dict[int, np.ndarray] = {}
        self.split: dict[int, tuple] = {}
        self.paths = [""]
        self._add(root)

    def _add(self, hist: np.ndarray) -> int:
        g, h, n = hist[:, 0].sum(1)
        self.nodes.append(Node(int(n), float(-self.rate * g / (h + self.l2))))
        at = len(self.nodes) - 1
        found = best_split(hist, self.min_leaf, self.l2) if n >= 2 * self.min_leaf else None
        if found:
            self.hist[at], self.split[at] = hist, found
        return at

    def next_leaves(self) -> list[int]:
        """Leaves whose children must be known for the queue to go on; none at the end. The
        first is certain to be split, the others may be."""
        queue, self.chosen, count = [], set(), 1
        if 0 in self.split:
            queue = [self._rank(0)]
        while queue and count < self.leaves:
            *_, at = queue[0]
            node = self.nodes[at]
            if node.left < 0:
                return [i for *_, i in heapq.nsmallest(self.leaves - count, queue) if self.nodes[i].left < 0]
            heapq.heappop(queue)
            self.chosen.add(at)
            count += 1
            for child in (node.left, node.right):
                if child in self.split:
                    heapq.heappush(queue, self._rank(child))
        return []

    def _rank(self, at: int) -> tuple:
        """Highest gain first; of ties the leaf with the smaller path from the root."""
        return -float(f"{self.split[at][0]:.9e}"), self.paths[at], at

    def open(self, leaves: list[int]) -> list[int]:
        """Split these leaves; the smaller child of each, whose histogram is asked for."""
        asked = []
        for at in leaves:
            gain, feature, cut, missing_left = self.split[at]
            rows = self.hist[at][2, feature]
            left = rows[: cut + 1].sum() + (rows[-1] if missing_left else 0)
            node = self.nodes[at]
            node.feature, node.bin, node.missing_left, node.gain = feature, cut, missing_left, gain
            node.left, node.right = len(self.nodes), len(self.nodes) + 1
            self.nodes += [Node(0, 0.0), Node(0, 0.0)]
            self.paths += [self.paths[at] + side for side in "01"]
            asked.append(node.left if left <= node.n - left else node.right)
        return asked

    def take(self, leaves: list[int], asked: list[int], found: np.ndarray) -> None:
        """The histograms of the asked children; their siblings' are the rest."""
        for k, (at, child) in enumerate(zip(leaves, asked)):
            node, hist = self.nodes[at], found[:, k]
            other = self.hist.pop(at) - hist
            for place, own in ((child, hist), (node.left + node.right - child, other)):
                added = self._add(own)
                self.nodes[place] = self.nodes.pop()
                if added in self.split:
                    self.hist[place], self.split[place] = self.hist.pop(added), self.split.pop(added)

    def finished(self) -> list[Node]:
        """The nodes that the queue has reached, numbered from the root in order."""
        out: list[Node] = []

        def copy(at: int) -> int:
            node, place = self.nodes[at], len(out)
            if at not in self.chosen:
                out.append(Node(node.n, node.value))
                return place
            out.append(Node(node.n, node.value, node.feature, node.bin, node.missing_left, node.gain))
            out[place].left = copy(node.left)
            out[place].right = copy(node.right)
            return place

        copy(0)
        return out


def _prepared(labelled: DataFrame, features: list[str], bins: int, hold_out: bool) -> tuple[list[list[float]], DataFrame]:
    """The cuts, and one staged row for each combination of codes with its counts."""
    edges = feature_edges(labelled, features, bins)
    codes = [f"c{i}" for i in range(len(features))]
    label = (F.col("label") == 1).cast("long")
    drawn = F.pmod(F.xxhash64(*labelled.columns), F.lit(1000)) < 1000 * HELD_OUT
    held = F.col("held")
    rows = labelled.select("label", (drawn if hold_out else F.lit(False)).alias("held"), *features)
    table = with_codes(rows, features, edges, "c").groupBy(*codes).agg(
        F.count_if(~held).alias("n"), F.sum(F.when(~held, label).otherwise(0)).alias("positive"),
        F.count_if(held).alias("held_n"), F.sum(F.when(held, label).otherwise(0)).alias("held_positive"),
    )
    return edges, stage(table, "codes")


def _log_odds(positive: int, n: int) -> float:
    if not n:
        return 0.0
    return math.log(positive / (n - positive)) if 0 < positive < n else math.copysign(30.0, positive - 0.5)


def first_splits(labelled: DataFrame, features: list[str], min_leaf: int = 50, l2: float = 1.0, bins: int = 255) -> list[tuple]:
    """The best split of all rows on each feature that can split them: ``(feature, gain, cut,
    missing_left)``, as a forest's first tree weighs them."""
    edges, table = _prepared(labelled, features, bins, False)
    n, positive = (int(x or 0) for x in table.agg(F.sum("n"), F.sum("positive")).first())
    if not 0 < positive < n:
        return []
    sizes = [len(cuts) + 2 for cuts in edges]
    passes = _ManyBlocks(table, sizes, _log_odds(positive, n))
    try:
        root, _ = passes([], [Node(0, 0.0)], [0])
    finally:
        passes.close()
    out = []
    for f, name in enumerate(features):
        if found := best_split(root[:, 0, f : f + 1], min_leaf, l2):
            gain, _, cut, missing_left = found
            out.append((name, gain, edges[f][cut] if cut < len(edges[f]) else math.inf, missing_left))
    return out


def boost(
    labelled: DataFrame,
    features: list[str],
    rounds: int = 150,
    learning_rate: float = 0.08,
    leaves: int = 31,
    min_leaf: int = 50,
    l2: float = 1.0,
    bins: int = 255,
    stop_early: bool | None = None,
) -> Forest:
    """Fit trees to ``label`` by logistic loss.

    With ``stop_early``, a tenth of the rows, drawn by a hash of them, is held out and boosting
    ends when ``PATIENCE`` rounds have not lowered their loss; None means: with more than
    ``STOP_EARLY_FROM`` rows. A table without rows gives a forest without trees.
    """
    if stop_early is None:
        stop_early = labelled.count() > STOP_EARLY_FROM
    edges, table = _prepared(labelled, features, bins, stop_early)
    totals = table.agg(F.count("*"), F.sum("n"), F.sum("positive"), F.sum("held_n")).first()
    distinct, n, positive, held_n = (int(x or 0) for x in totals)
    forest = Forest(list(features), edges, _log_odds(positive, n))
    if not 0 < positive < n:  # nothing to tell apart
        return forest
    sizes = [len(cuts) + 2 for cuts in edges]
    options = rounds, learning_rate, leaves, min_leaf, l2, held_n if stop_early else 0
    blocks = max(1, -(-distinct // ROWS_PER_BLOCK))
    if blocks == 1:
        base, bins = forest.base, max(sizes)
        grown = _blocks(table.repartition(1), sizes, lambda block: _grown(_OneBlock(block, base, bins), *options))
        forest.trees = pickle.loads(grown.first()["data"])
        return forest
    passes = _ManyBlocks(table.repartition(blocks), sizes, forest.base)
    try:
        forest.trees = _grown(passes, *options)
    finally:
        passes.close()
    return forest


def _grown(passes, rounds: int, rate: float, leaves: int, min_leaf: int, l2: float, held_n: int) -> list[list[Node]]:
    """Tree after tree from ``passes`` over the rows."""
    trees: list[list[Node]] = []
    losses: list[float] = []
    while len(trees) < rounds:
        root, loss = passes(trees, [Node(0, 0.0)], [0], loss=held_n > 0)
        losses.append(loss / max(held_n, 1))
        if held_n and _stalled(losses):
            break
        tree = Tree(root[:, 0], leaves, min_leaf, l2, rate)
        while opened := tree.next_leaves():
            asked = tree.open(opened)
            tree.take(opened, asked, passes(trees, tree.nodes, asked)[0])
        nodes = tree.finished()
        if len(nodes) == 1:  # no split is left that gains
            break
        trees.append(nodes)
    return trees


def _stalled(losses: list[float]) -> bool:
    if len(losses) <= PATIENCE:
        return False
    return min(losses[-PATIENCE:]) >= losses[-PATIENCE - 1] - TOLERANCE
