"""Best-fit packing of documents into sequences of fixed length.

Bulk-synchronous best-fit. Pieces are range-sorted by length, longest first. In each
round all pieces of one length look for their successor among the gaps: the smallest gap
that holds them. Pieces that want the same gap are told apart by rank: the k-th piece takes
the k-th sequence with that gap. Gaps are then updated and the next round begins; pieces
without any gap open new sequences.

Pieces of equal length are alike, and so are sequences that were filled alike. So a round
works on runs: a length with its number of pieces, a gap with its runs of sequence numbers.
There are at most as many lengths and gaps as a sequence has tokens, whatever the size of
the input; the rounds take this table of counts, and give for each run of ranks the run of
sequences it goes to. Pieces themselves stay in Spark: they are counted by length, sorted,
numbered, and each looks up its run.

A document longer than a sequence is cut into full pieces and a rest. Null texts are
empty: one piece that holds the end id. Rows that repeat are packed as often as they occur.
An empty table has no piece.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common, tokens
from kindred.session import stage

SEQUENCE = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, length: int = SEQUENCE, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document; with ``keep_ids`` also their ids as bytes (``<u4``)."""
    vocabulary = vocabulary or tokens.default_vocabulary()
    fields = [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ] + [("ids", pa.binary())] * keep_ids
    schema = pa.schema(fields)
    step = 4 * length

    def run(batches):
        encoder = tokens.encoder(vocabulary)
        for batch in common.slices(batches):
            rows = []
            encoded = encoder.encode(batch.column("text").cast(pa.binary()).to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(fields)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

    return common.texts(docs).mapInArrow(run, PIECES + ", ids binary" * keep_ids)


def plan_rounds(counts: dict[int, int], length: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """Runs ``(first place, length, first sequence, offset)`` in the order of places.

    Places number the pieces from the longest to the shortest. The piece at place
    ``first + k`` of a run goes to sequence ``first sequence + k`` at ``offset``.
    """
    runs, place, opened = [], 0, 0
    gaps: list[int] = []  # the gaps in use, ascending
    holders: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, count)

    def put(gap: int, first: int, count: int) -> None:
        if gap <= 0:
            return
        if gap not in holders:
            bisect.insort(gaps, gap)
            holders[gap] = []
        holders[gap].append((first, count))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(gaps, size)
            if at == len(gaps):
                # As many new sequences as the pieces of this length fill.
                new = -(-left // (length // size))
                runs.append((place, size, opened, 0))
                put(length - size, opened, new)
                opened, place, left = opened + new, place + new, left - new
                continue
            gap = gaps[at]
            first, count = holders[gap].pop()
            taken = min(count, left)
            if taken < count:
                holders[gap].append((first + taken, count - taken))
            if not holders[gap]:
                del holders[gap], gaps[at]
            runs.append((place, size, first, length - gap))
            put(gap - size, first, taken)
            place += taken
            left -= taken
    return runs


def number_sorted(rows: DataFrame, *order) -> DataFrame:
    """``rows`` in range partitions by ``order``, numbered from 0 (``_place``), staged."""
    sorted_rows = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "sorted",
    )
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    offsets = sorted_rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return (
        sorted_rows.withColumn("_part", part).join(offsets, "_part")
        .withColumn("_place", F.col("_before") + F.col("_at") - F.shiftleft("_part", 33))
        .drop("_part", "_before", "_at")
    )


def place(found: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """``found`` pieces with ``sequence_id`` and ``offset``."""
    spark = found.sparkSession
    numbered = number_sorted(found, F.desc("length"), F.asc("doc_id"), F.asc("start"), F.asc("ids_crc32"))
    # At most `length` rows.
    counts = {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}
    runs = np.array(plan_rounds(counts, length), np.int64).reshape(-1, 4)
    # Bounded by the length of a sequence, not by the number of pieces.
    shared = spark.sparkContext.broadcast((runs[:, 0], runs[:, 2], runs[:, 3]))
    schema = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64())])
    names = [c for c in numbered.columns if c != "_place"]

    def run(batches):
        firsts, sequences, offsets = shared.value
        for batch in batches:
            places = batch.column("_place").to_numpy()
            at = np.searchsorted(firsts, places, "right") - 1
            added = [pa.array(sequences[at] + places - firsts[at]), pa.array(offsets[at])]
            columns = [batch.column(c) for c in names] + added
            yield pa.RecordBatch.from_arrays(columns, names=names + schema.names)

    types = ", ".join(f"{c} {t}" for c, t in numbered.select(names).dtypes)
    return numbered.mapInArrow(run, f"{types}, sequence_id long, offset long")


def pack(docs: DataFrame, length: int = SEQUENCE, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Every piece of ``docs`` with its sequence and its place there."""
    # Staged, as sorting by range reads its input twice.
    return place(stage(pieces(docs, length, vocabulary, keep_ids), "pieces"), length)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
