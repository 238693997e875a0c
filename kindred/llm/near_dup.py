"""Near-duplicates by a signature-coordinate inverted join.

1. Every text becomes its set of word shingles. The hash space is cut into ``COORDINATES``
   ranges and the smallest hash in a range is the signature's value there: a MinHash by one
   permutation. A value names its coordinate, so value and coordinate are one number.
   Texts with equal sets form a class; from here on there is one row per class.
2. Classes are posted under their values. Values that only one class has cannot match.
3. Prefix: sets as similar as asked for agree on at least ``need`` coordinates (see below).
   With all values put in one order, rarest first, they then share one among the first
   ``e - need + 1`` of their ``e`` values, so only those are kept as lists. Skip: the long
   lists of common passages come last and are not merged at all.
4. Lists that share a class are gathered to pools: whatever is linked is in one pool. No list
   is squared in the join; each class meets one other class of each of its lists.
5. Pools are dealt to tasks in units of about ``UNIT`` shingles: small pools together, large
   ones in pieces by size and hash, every two pieces whose sizes allow a link once. A task
   posts its classes under their values, counts collisions, retains pairs that agree on
   ``need`` coordinates and confirms them on the whole sets. It leaves out pairs that it has
   linked by others already, so it returns fewer links than it has classes.

A pair at the similarity of 0.8 agrees on each coordinate with probability 0.8, so the share
of 128 coordinates lies 5 standard deviations above ``MATCHES``. And each shingle that only
one of two sets has can spoil one coordinate at most, which for small sets is the higher bound.

A null text is empty. A text without words has no shingles and is linked with nothing. Rows
that share an id are different documents with one id. Null ids are larger than any id: a
component of null ids alone has the id null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.llm import common
from kindred.llm.components import components
from kindred.llm.shingles import document_shingles
from kindred.session import stage

COORDINATES = 128  # a power of two
MATCHES = 0.62
SIMILARITY = 80  # per cent of the union
UNIT = 150_000  # shingles a task holds of either side, unless one text has more
SENT = 2_000_000  # rows of two numbers that are sent to every executor, not joined by shuffle

_SHIFT = np.uint64(64 - (COORDINATES.bit_length() - 1))


def _signature(found: np.ndarray) -> np.ndarray:
    """The first, so smallest, of the sorted hashes in each range."""
    ranges = found >> _SHIFT
    first = np.ones(len(found), bool)
    first[1:] = ranges[1:] != ranges[:-1]
    return found[first].view(np.int64)


def _digest(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def signatures(docs: DataFrame, size: int, row: str) -> DataFrame:
    """``row, doc_id, n_shingles, digest, signature`` per row of ``docs``."""
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()),
         ("digest", pa.binary()), ("signature", pa.list_(pa.int64()))]
    )

    def run(batches):
        for batch in common.slices(batches):
            counts, digests, values, ends = [], [], [], [0]
            for found in document_shingles(batch.column("text"), size):
                counts.append(len(found))
                digests.append(_digest(found))
                values.append(_signature(found))
                ends.append(ends[-1] + len(values[-1]))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(digests, pa.binary()), lists],
                schema=schema,
            )

    return common.texts(docs, F.col(row).cast("long").alias("row")).mapInArrow(
        run, "row long, doc_id long, n_shingles long, digest binary, signature array<long>"
    )


def _need(e: F.Column, n: F.Column, percent: int) -> F.Column:
    """Coordinates on which a set of ``n`` shingles, with ``e`` coordinates, must agree with
    a similar one."""
    union = F.floor(n * 100 / percent)
    apart = F.floor(union * (100 - percent) / 100)
    return F.greatest(F.ceil(F.lit(MATCHES) * e), e - apart, F.lit(1)).cast("int")


def need(e: int, n: int, percent: int) -> int:
    """The same for one set."""
    union = n * 100 // percent
    return max(int(np.ceil(MATCHES * e)), e - union * (100 - percent) // 100, 1)


def _lists(classes: DataFrame, percent: int) -> DataFrame:
    """``value, cls``: the posting lists of the prefixes."""
    e = F.size("signature")
    postings = classes.select(
        "cls", e.alias("e"), _need(e, F.col("n_shingles"), percent).alias("need"), F.explode("signature").alias("value")
    )
    uses = stage(postings.groupBy("value").agg(F.count("*").alias("uses")).where("uses > 1"), "uses")
    shared = postings.join(uses, "value")
    # A class has a bounded number of values.
    own = Window.partitionBy("cls")
    ranked = shared.select(
        "*",
        F.row_number().over(own.orderBy("uses", "value")).alias("rank"),
        F.count("*").over(own).alias("found"),
    )
    # Values that no other class has come first in the order.
    return stage(ranked.where("rank + e - found <= e - need + 1").select("value", "cls"), "lists")


def _pools(lists: DataFrame) -> DataFrame:
    """``cls, pool`` of the classes that share a list with another."""
    hubs = stage(lists.groupBy("value").agg(F.min("cls").alias("hub")), "hubs")
    met = lists.join(hubs, "value").where("hub < cls").select("hub", "cls").distinct()
    return stage(components(met, "hub", "cls").toDF("cls", "pool"), "pools")


def _dealt(members: DataFrame) -> DataFrame:
    """``row, cls, tasks``: the tasks of each class as ``(task, side)``. In a task, classes of
    side 0 meet those of side 1, and classes of side 2 meet each other.

    Tasks are numbered by hashes; should two agree, they are one task, which does no harm.
    """
    # A class of this size and one of the next or of the same may be similar.
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(1.25)).cast("int")
    members = members.withColumn("band", band)
    pools = stage(members.groupBy("pool").agg(F.sum("n").alias("total")), "pool-sizes")
    small = pools.where(F.col("total") <= UNIT)
    bundles = small.agg((F.coalesce(F.sum("total"), F.lit(0)) / UNIT).cast("long") + 1).first()[0]
    together = members.join(small, "pool").select(
        "row", "cls",
        F.array(F.struct(F.pmod(F.xxhash64("pool"), F.lit(bundles)).alias("task"), F.lit(2).alias("side"))).alias("tasks"),
    )
    apart = members.join(pools.where(F.col("total") > UNIT).select("pool"), "pool")
    pieces = stage(
        apart.groupBy("pool", "band").agg((F.sum("n") / UNIT).cast("int").alias("last")), "pieces"
    )
    placed = apart.join(pieces, ["pool", "band"]).withColumn(
        "piece", F.pmod(F.xxhash64("cls"), F.col("last") + 1).cast("int")
    )

    def neighbour(step: int, name: str) -> DataFrame:
        return pieces.select("pool", (F.col("band") + step).alias("band"), F.col("last").alias(name))

    placed = placed.join(neighbour(-1, "above"), ["pool", "band"], "left").join(
        neighbour(1, "below"), ["pool", "band"], "left"
    )
    piece, own = F.col("piece"), F.col("band")

    def task(low_band, low_piece, high_band, high_piece, side):
        return F.struct(
            F.xxhash64("pool", low_band, low_piece, high_band, high_piece).alias("task"), side.cast("int").alias("side")
        )

    def each(last, make):
        none = F.array().cast("array<struct<task:bigint,side:int>>")
        return F.when(last.isNull(), none).otherwise(F.transform(F.sequence(F.lit(0), last), make))

    same = each(
        F.col("last"),
        lambda other: task(
            own, F.least(piece, other), own, F.greatest(piece, other),
            F.when(other == piece, 2).when(piece < other, 0).otherwise(1),
        ),
    )
    above = each(F.col("above"), lambda other: task(own, piece, own + 1, other, F.lit(0)))
    below = each(F.col("below"), lambda other: task(own - 1, other, own, piece, F.lit(1)))
    return together.union(placed.select("row", "cls", F.concat(same, above, below).alias("tasks")))


def _sets(docs: DataFrame, dealt: DataFrame, size: int, row: str) -> DataFrame:
    """``task, side, cls, found``: the whole sets of the ``dealt`` classes, from one row each."""
    schema = pa.schema([("cls", pa.int64()), ("found", pa.binary())])

    def run(batches):
        for batch in common.slices(batches):
            found = [x.tobytes() for x in document_shingles(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(found, pa.binary())], schema=schema)

    wanted = stage(dealt, "dealt")
    rows = wanted.select("row", "cls")
    if wanted.count() <= SENT:
        rows = F.broadcast(rows)
    texts = common.texts(docs, F.col(row).cast("long").alias("row")).join(rows, "row").select("cls", "text")
    sets = texts.mapInArrow(run, "cls long, found binary")
    tasks = wanted.select("cls", F.explode("tasks").alias("t")).select("cls", "t.task", "t.side")
    return sets.join(tasks, "cls").select("task", "side", "cls", "found")


def linked(sides: list[int], found: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links among the sets of one task, as pairs of their places, enough to join all that
    are linked there."""
    own = [_signature(x) for x in found]
    sizes = np.array([len(x) for x in found])
    least = np.array([need(len(v), len(x), percent) for v, x in zip(own, found)])
    side = np.array(sides)
    values = np.concatenate(own)
    holders = np.repeat(np.arange(len(own)), [len(v) for v in own])
    order = np.argsort(values, kind="stable")
    values, holders = values[order], holders[order]
    root = np.arange(len(own))  # of each set, by what has been linked so far
    links = []
    for k in np.flatnonzero(side != 1):
        first, last = np.searchsorted(values, own[k], "left"), np.searchsorted(values, own[k], "right")
        if (last - first).sum() == len(own[k]):
            continue  # no other set has any of the values
        met = np.bincount(np.concatenate([holders[i:j] for i, j in zip(first, last)]), minlength=len(own))
        may = (met >= np.maximum(least, least[k])) & (root != root[k])
        may &= 100 * np.minimum(sizes, sizes[k]) >= percent * np.maximum(sizes, sizes[k])
        may &= (side == 1) if side[k] == 0 else (np.arange(len(own)) > k) & (side == 2)
        for j in np.flatnonzero(may):
            if root[j] == root[k]:
                continue
            both = np.sort(np.concatenate((found[k], found[j])))
            shared = int((both[1:] == both[:-1]).sum())
            if 100 * shared >= percent * (len(both) - shared):
                links.append((int(k), int(j)))
                root[root == root[j]] = root[k]
    return links


def class_links(classes: DataFrame, docs: DataFrame, size: int, row: str, percent: int = SIMILARITY) -> DataFrame:
    """``(node, root)`` of the classes that are linked with others."""
    pools = _pools(_lists(classes, percent))
    members = pools.join(classes.select("cls", "row", F.col("n_shingles").alias("n")), "cls")
    sets = _sets(docs, _dealt(stage(members, "members")), size, row)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        found = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("found")]
        cls = table.column("cls").to_numpy()
        pairs = linked(table.column("side").to_pylist(), found, percent)
        return pa.Table.from_arrays(
            [pa.array([cls[i] for i, _ in pairs], pa.int64()), pa.array([cls[j] for _, j in pairs], pa.int64())],
            schema=schema,
        )

    links = stage(sets.groupBy("task").applyInArrow(run, "a long, b long"), "links")
    return components(links)


def near_duplicates(docs: DataFrame, size: int = 5, row: str = "row", percent: int = SIMILARITY) -> DataFrame:
    """Per row of ``docs``, which has a unique ``row`` number: ``row, doc_id, n_shingles,
    component_id`` and ``first``, true for one row of each component."""
    rows = stage(signatures(docs, size, row), "signatures")
    classes = stage(
        rows.where("n_shingles > 0").groupBy("digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("rep"),
            F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
        )
        .select("digest", F.col("rep.row").alias("row"), "rep", "n_shingles", "signature",
                F.monotonically_increasing_id().alias("cls")),
        "classes",
    )
    roots = class_links(classes, docs, size, row, percent)
    rooted = classes.join(roots, F.col("cls") == F.col("node"), "left").select(
        "digest", "rep", F.coalesce("root", "cls").alias("root")
    )
    rooted = stage(rooted, "rooted")
    heads = stage(rooted.groupBy("root").agg(F.min("rep").alias("head")), "heads")
    named = stage(rooted.join(heads, "root").select("digest", "head"), "named")
    return rows.select("row", "doc_id", "n_shingles", "digest").join(named, "digest", "left").select(
        "row", "doc_id", "n_shingles",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.coalesce(F.col("head.row") == F.col("row"), F.lit(True)).alias("first"),
    )


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique number per row, written once so that the numbers stay, and
    the name of that column."""
    name = common.free_name(docs, "_row")
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def deduplicated(docs: DataFrame, size: int = 5, percent: int = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component, all columns kept."""
    rows, name = numbered(docs)
    kept = near_duplicates(rows, size, name, percent).where("first").select(F.col("row").alias(name))
    return rows.join(kept, name, "left_semi").select(*docs.columns)


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs, name = numbered(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = near_duplicates(docs, 4, name)
    return found.select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id").eqNullSafe(F.col("component_id")), F.lit(False)).alias("kept"),
    )


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY ALL
), both_have AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y USING (h) WHERE x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM both_have JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), near AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT near.b, reach.root FROM reach JOIN near ON near.a = reach.node
), lowest AS (
  SELECT node, min(root) AS component_id FROM reach GROUP BY ALL
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN lowest ON node = d.doc_id
"""
