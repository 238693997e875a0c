"""Nearest neighbours by stable projections and kd-trees, with a chi-square stopping test.

Vectors are projected by a Gaussian matrix to ``DIMS`` numbers. A projected squared distance
over the true one is distributed as chi-square with ``DIMS`` degrees of freedom. A kd-tree over the
projections yields a query's projected neighbours, nearest first; each is verified on the
original vectors, and the search stops when a vector as near as the k-th best found so far
would have been met before with probability ``SURE``. Nothing else ends a search: there is no cap
on the vectors that are verified. Rounding is allowed for by ``SLACK`` of the squared length.

The tree has two parts. Its top is split at medians of a sample of at most ``SAMPLE`` projections;
every vector is dealt to a cell of it, and a large cell by hash to blocks of about ``BLOCK``
vectors. The bottom is built in the task that gets a block. A query first searches its own
block. The k-th distance found there bounds it, and it goes to the blocks of all cells that the
test does not rule out. A task gets one block and about ``QUERIES`` queries at most, of neighbouring
cells, so that a block is only copied for queries that lie near each other and near it.

Identical vectors are one point with the smallest k + 1 of their ids, so that a vector held by
very many rows is one point, and equal query vectors search once. Ids are limited by rank
before the exchange.

A vector takes no part if its id is null, or if it is null, zero, or holds null or non-finite
entries or some beyond ``LARGEST``, whose squares are not finite. Vectors of different lengths have no distance and do not meet. Rows equal in id and
vector count once; a candidate with the query's id is the query's own row. Of equal
distances the smaller id comes first. An empty table, or one without queries, gives no rows.
Further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common
from kindred.llm.whitening import matrix
from kindred.session import stage

NEAREST = 10
DIMS = 12  # an even number
SURE = 0.99
SAMPLE = 8192
SAMPLED_IN_CELL = 32  # sampled vectors of a cell of the top
BLOCK = 8192
QUERIES = 8192
LEAF = 64
SEED = 2024
SLACK = 1e-12
LARGEST = 1e150


def chi_square(x: float, freedom: int = DIMS) -> float:
    """The distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for k in range(1, freedom // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def stop_ratio(sure: float = SURE, freedom: int = DIMS) -> float:
    """The ratio of squared distances, projected to true, at which the test holds."""
    low, high = 0.0, 1.0
    while chi_square(high, freedom) < sure:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < sure else (low, middle)
    return high


def projection(dims: int) -> np.ndarray:
    return np.random.default_rng([SEED, dims]).standard_normal((dims, DIMS))


class Tree:
    """A kd-tree of medians. ``order`` lists the rows leaf by leaf; ``edges`` says where leaves begin."""

    def __init__(self, rows: np.ndarray, leaf: int):
        self.splits: list[tuple[int, float, int, int]] = []  # dimension, value, node below, node above
        self.leaves: list[np.ndarray] = []
        self.root = self._build(rows, np.arange(len(rows)), leaf)

    def _build(self, rows: np.ndarray, members: np.ndarray, leaf: int) -> int:
        """The number of a node: a split's, or for leaf j the negative -1 - j."""
        if len(members) > leaf:
            part = rows[members]
            dim = int(np.argmax(part.max(0) - part.min(0)))
            value = float(np.median(part[:, dim]))
            below = part[:, dim] < value
            if below.any():
                node = len(self.splits)
                self.splits.append((dim, value, 0, 0))
                low, high = (self._build(rows, members[side], leaf) for side in (below, ~below))
                self.splits[node] = (dim, value, low, high)
                return node
        self.leaves.append(members)
        return -len(self.leaves)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        at = np.full(len(rows), self.root)
        while (inner := np.flatnonzero(at >= 0)).size:
            for node in np.unique(at[inner]).tolist():
                dim, value, low, high = self.splits[node]
                here = inner[at[inner] == node]
                at[here] = np.where(rows[here, dim] < value, low, high)
        return -1 - at


def box_distances(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every box."""
    out = np.zeros((len(rows), len(low)))
    for d in range(rows.shape[1]):
        c = rows[:, d, None]
        out += np.maximum(0, np.maximum(low[:, d] - c, c - high[:, d])) ** 2
    return out


class Block:
    """The points of one task, indexed by their projections."""

    def __init__(self, points: np.ndarray, ids: list[list[int]]):
        self.matrix = projection(points.shape[1])
        projected = points @ self.matrix
        tree = Tree(projected, LEAF)
        order = np.concatenate(tree.leaves) if tree.leaves else np.empty(0, int)
        self.points, self.projected, self.ids = points[order], projected[order], [ids[i] for i in order.tolist()]
        self.edges = np.cumsum([0, *map(len, tree.leaves)])
        begins = self.edges[:-1]
        self.low = np.minimum.reduceat(self.projected, begins) if len(points) else projected
        self.high = np.maximum.reduceat(self.projected, begins) if len(points) else projected

    def search(self, queries: np.ndarray, reach: np.ndarray, k: int, ratio: float):
        """For each query the ``k`` nearest ``(squared distance, id)`` found; ``reach`` is a squared
        distance within which it has ``k`` neighbours, infinite if not known."""
        projected = queries @ self.matrix
        nearest_first = box_distances(projected, self.low, self.high)
        slack = SLACK * (projected**2).sum(1)
        for query, own, boxes, bound, more in zip(queries, projected, nearest_first, reach.tolist(), slack.tolist()):
            leaves = np.argsort(boxes, kind="stable")
            near, at = boxes[leaves], 0
            best, places, step = np.empty(0), np.empty(0, int), 1
            while at < len(leaves) and near[at] <= ratio * bound + more:
                taken = leaves[at : at + step]
                rows = np.concatenate([np.arange(self.edges[j], self.edges[j + 1]) for j in taken.tolist()])
                at, step = at + step, 2 * step
                rows = rows[((self.projected[rows] - own) ** 2).sum(1) <= ratio * bound + more]
                best = np.concatenate([best, ((self.points[rows] - query) ** 2).sum(1)])
                places = np.concatenate([places, rows])
                if len(best) > k:
                    kept = np.argpartition(best, k - 1)
                    limit = best[kept[k - 1]]
                    kept = np.flatnonzero(best <= limit)  # ties stay, ids decide
                    best, places = best[kept], places[kept]
                if len(best) >= k:
                    bound = min(bound, float(np.partition(best, k - 1)[k - 1]))
            found = [(d, i) for d, p in zip(best.tolist(), places.tolist()) for i in self.ids[p]]
            yield sorted(found)[:k]


def usable(vector: Column) -> Column:
    entries = vector.cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < LARGEST))
    return F.when(finite & F.exists(entries, lambda c: c != 0), entries)


def _vectors(rows: DataFrame, vector: str, key: str) -> DataFrame:
    # Adding zero makes -0.0 the same as 0.0.
    entries = F.transform(usable(F.col(vector)), lambda c: c + F.lit(0.0))
    return rows.select(F.col(key).cast("long").alias("id"), entries.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")


def _points(vectors: DataFrame, ids: int) -> DataFrame:
    """Every vector once, with the smallest ``ids`` of its ids."""
    rank = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    first = vectors.withColumn("rank", rank).where(F.col("rank") <= ids)
    return first.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def _by_length(batches):
    """The rows of each length of vector: as a batch, their vectors, and the length."""
    for batch in batches:
        sizes = np.diff(batch.column("v").offsets.to_numpy())
        for dims in np.unique(sizes).tolist():
            part = batch.filter(pa.array(sizes == dims))
            yield part, matrix(part.column("v"), dims), dims


def top_tree(points: DataFrame, total: int) -> Tree | None:
    """Splits at medians of the projections of vectors with the smallest hashes."""
    cells = max(1, min(total // BLOCK, SAMPLE // SAMPLED_IN_CELL))
    if cells == 1:
        return None
    taken = cells * SAMPLED_IN_CELL
    rows = points.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(taken).select("v").collect()
    return Tree(np.array([np.array(r["v"]) @ projection(len(r["v"])) for r in rows]), SAMPLED_IN_CELL * 3 // 2)


def with_cells(table: DataFrame, tree: Tree | None) -> DataFrame:
    """``table`` with the length of ``v`` and its cell."""

    def run(batches):
        for part, v, dims in _by_length(batches):
            cells = np.zeros(len(v), int) if tree is None else tree.leaf_of(v @ projection(dims))
            columns = [*part.columns, pa.array(np.full(len(v), dims), pa.int32()), pa.array(cells, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "dims", "cell"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    return table.mapInArrow(run, f"{fields}, dims int, cell int")


def _boxes(points: DataFrame) -> dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]]:
    """By length and cell: the number of points and the box of their projections. A cell is a
    leaf of the top, so there are few, whatever the input."""

    def run(batches):
        found: dict = {}
        for part, v, dims in _by_length(batches):
            projected, cells = v @ projection(dims), part.column("cell").to_numpy()
            for cell in np.unique(cells).tolist():
                own = projected[cells == cell]
                n, low, high = found.get((dims, cell), (0, np.inf, -np.inf))
                found[dims, cell] = n + len(own), np.minimum(low, own.min(0)), np.maximum(high, own.max(0))
        rows = [
            dict(dims=d, cell=c, n=n if k == 0 else 0, k=k, low=float(low[k]), high=float(high[k]))
            for (d, c), (n, low, high) in found.items() for k in range(DIMS)
        ]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [("dims", pa.int32()), ("cell", pa.int32()), ("n", pa.int64()), ("k", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]
    )
    parts = points.select("v", "dims", "cell").mapInArrow(run, "dims int, cell int, n long, k int, low double, high double")
    out: dict = {}
    merged = parts.groupBy("dims", "cell", "k").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    for r in merged.collect():
        held = out.setdefault((r["dims"], r["cell"]), [0, np.empty(DIMS), np.empty(DIMS)])
        held[0] += r["n"]
        held[1][r["k"]], held[2][r["k"]] = r["low"], r["high"]
    return {key: tuple(held) for key, held in out.items()}


FOUND = "key long, h long, id long, d2 double"
_FOUND = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("id", pa.int64()), ("d2", pa.float64())])


def _searched(points: DataFrame, queries: DataFrame, by: list[str], k: int, ratio: float) -> DataFrame:
    """What the queries of a block find among its points; ``queries`` have ``reach``."""

    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _FOUND.empty_table()
        dims = key[by.index("dims")].as_py()
        block = Block(matrix(left["v"].combine_chunks(), dims), left["ids"].to_pylist())
        queries = matrix(right["v"].combine_chunks(), dims)
        keys, hashes = right["key"].to_pylist(), right["h"].to_pylist()
        out: tuple[list, ...] = ([], [], [], [])
        for own, h, found in zip(keys, hashes, block.search(queries, right["reach"].to_numpy(), k, ratio)):
            for d2, i in found:
                for column, value in zip(out, (own, h, i, d2)):
                    column.append(value)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, _FOUND)], schema=_FOUND)

    return points.groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(run, FOUND)


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = NEAREST, vector: str = "embedding", key: str = "vec_id", sure: float = SURE
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each of ``queries`` its nearest rows and their
    Euclidean distances. Queries have the columns of ``rows``."""
    ratio, wanted = stop_ratio(sure), k + 1
    asked = _vectors(queries, vector, key).distinct()
    points = stage(_points(_vectors(rows, vector, key), wanted), "points")
    tree = top_tree(points, points.count())
    points = stage(with_cells(points, tree), "celled")
    boxes = _boxes(points)

    if not boxes:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # A cell's points are dealt to blocks by hash, its own number of blocks each.
    blocks = {c: -(-n // BLOCK) for c, (n, _, _) in boxes.items()}
    block = F.pmod(F.xxhash64("v"), F.coalesce(_looked_up(blocks), F.lit(1))).cast("int")
    points = points.withColumn("block", block)

    # Equal query vectors search once.
    once = asked.groupBy("v").agg(F.min("id").alias("key")).withColumn("h", F.xxhash64("v"))
    once = stage(with_cells(once, tree).withColumn("block", block), "queries")
    unbounded = once.withColumn("reach", F.lit(float("inf")))
    home = _searched(points, unbounded, ["dims", "cell", "block"], wanted, ratio)
    reach = home.groupBy("key", "h").agg(F.when(F.count("*") >= wanted, F.max("d2")).alias("bound"))
    first, parts = _query_parts(once)
    bounded = once.join(reach, ["key", "h"], "left").select(
        "key", "h", "v", "dims", F.coalesce("bound", F.lit(float("inf"))).alias("reach"),
        (_looked_up(first) + F.pmod("h", _looked_up(parts))).cast("int").alias("part"),
    )
    sent = stage(_sent(bounded, boxes, blocks, ratio), "sent")
    wanted_by = sent.groupBy("dims", "cell").agg(F.collect_set("part").alias("parts"))
    copies = points.join(wanted_by, ["dims", "cell"]).withColumn("part", F.explode("parts")).drop("parts")
    found = _searched(copies, sent, ["dims", "cell", "block", "part"], wanted, ratio)

    order = Window.partitionBy("key", "h").orderBy("d2", "id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted)
    lists = best.groupBy("key", "h").agg(F.sort_array(F.collect_list(F.struct("place", "id", "d2"))).alias("near"))
    named = once.select("key", "h", "v").join(lists, ["key", "h"]).select("v", "near")
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("query_id")), 1, k)
    return (
        asked.withColumnRenamed("id", "query_id").join(named, "v")
        .select("query_id", F.posexplode(others).alias("at", "one"))
        .select(
            "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.id").alias("vec_id"),
            F.sqrt("one.d2").alias("score"),
        )
    )


def _looked_up(of: dict[tuple[int, int], int]) -> Column:
    """The number that a row's length and cell have."""
    pairs = [F.lit(x) for (dims, cell), n in of.items() for x in (f"{dims}/{cell}", n)]
    return F.create_map(*pairs)[F.concat_ws("/", "dims", "cell")] if pairs else F.lit(None).cast("int")


def _query_parts(queries: DataFrame) -> tuple[dict, dict]:
    """For each length and cell the first part of its queries and their number of parts. Cells
    with few queries share a part with those that follow in the tree."""
    first, parts, at, held = {}, {}, 0, 0
    rows = queries.groupBy("dims", "cell").count().orderBy("dims", "cell").collect()
    for r in rows:  # a row for each leaf of the top
        own = -(-r["count"] // QUERIES)
        if held and (own > 1 or held + r["count"] > QUERIES):
            at, held = at + 1, 0
        first[r["dims"], r["cell"]], parts[r["dims"], r["cell"]] = at, own
        at, held = (at + own, 0) if own > 1 else (at, held + r["count"])
    return first, parts


def _sent(queries: DataFrame, boxes: dict, blocks: dict, ratio: float) -> DataFrame:
    """``queries`` once for every block of a cell that the stopping test does not rule out."""
    fields = {f.name: f.dataType.simpleString() for f in queries.schema}

    def run(batches):
        for part, v, dims in _by_length(batches):
            cells = [c for d, c in boxes if d == dims]
            low, high = (np.array([boxes[dims, c][side] for c in cells]) for side in (1, 2))
            projected = v @ projection(dims)
            limit = ratio * part.column("reach").to_numpy() + SLACK * (projected**2).sum(1)
            near = box_distances(projected, low, high) <= limit[:, None]
            for j, c in enumerate(cells):
                chosen = part.filter(pa.array(near[:, j]))
                for b in range(blocks[dims, c] if chosen.num_rows else 0):
                    place = [pa.array(np.full(chosen.num_rows, x), pa.int32()) for x in (c, b)]
                    yield pa.RecordBatch.from_arrays([*chosen.columns, *place], names=[*fields, "cell", "block"])

    return queries.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in fields.items()) + ", cell int, block int")


def op12_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 100 == 0))
