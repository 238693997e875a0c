"""Scoring of texts by prediction by partial matching.

Model. Bytes of the lower-cased texts (A-Z only), ``ORDER`` bytes of context. Byte 255, which
UTF-8 lacks, stands before and ends every text. The trie is a table: how often each byte
followed each context in the training documents. A byte that followed its context has the
probability ``count / (total + kinds)``; otherwise the model escapes, with probability
``kinds / (total + kinds)``, to the context without its first byte, where all bytes that the
longer context had are excluded from counts, totals and kinds (escape method C). Contexts
never seen are skipped. What no context had shares the rest evenly among the 256 bytes.

Distribution. The number of contexts and words grows with the corpus, so no task holds the
model. Texts are written in blocks of about ``BLOCK_BYTES``. Each block gives its distinct
runs of bytes and words with their training counts; counts are summed by key over all
blocks; and every block gets the sums, and the costs made from them, of its own keys back. A block's
dictionary is thus no larger than its text.

Null texts are empty: one end of text. Documents with a null id train the model (their id
counts as empty text). Rows that repeat count each. A text longer than a block is a block
of its own.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common
from kindred.session import stage

ORDER = 4
BLOCK_BYTES = 32 << 20
EDGE = 255  # before and after a text

END_WORD = b""  # the end of a text among the words


def held_out(column: str = "doc_id"):
    return common.id_bucket(column, 7) == 2


def blocked(docs: DataFrame) -> DataFrame:
    """``block, doc_id, held_out, text``, staged; the rows of a block follow one another."""
    rows = common.texts(docs, held_out().alias("held_out"))
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.string())])

    def run(batches):
        first, size, block = TaskContext.get().partitionId() << 32, 0, 0
        for batch in common.slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, first + block)), *(batch.column(c) for c in schema.names[1:])],
                schema=schema,
            )
            size += batch.column("text").nbytes
            if size >= BLOCK_BYTES:
                size, block = 0, block + 1

    return stage(rows.mapInArrow(run, "block long, doc_id long, held_out boolean, text string"), "blocks")


def codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end, the run of ``order`` bytes before it and the
    byte itself as one number; and where each text begins among them."""
    edge = bytes([EDGE])
    lead = edge * order
    raw = np.frombuffer(b"".join(lead + text + edge for text in texts), np.uint8)
    lengths = np.array([len(text) + 1 for text in texts], np.int64)
    begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    found = np.zeros(max(0, len(raw) - order), np.int64)
    for k in range(order + 1):
        found <<= 8
        found |= raw[k : len(raw) - order + k]
    # A number that starts less than `order` before the next text runs over its lead.
    keep = np.ones(len(found), bool)
    ends = np.cumsum(lengths + order)[:-1]
    for k in range(order):
        keep[ends - order + k] = False
    return found[keep], begins


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


class BlockCounts:
    """Distinct words and runs of one block with their counts in training texts."""

    def __init__(self, order: int):
        self.order, self.words, self.keys, self.counts = order, Counter(), [], []

    def add(self, texts: list[bytes], held: list[bool]) -> None:
        for part in (False, True):
            own = [text for text, h in zip(texts, held) if h == part]
            if not own:
                continue
            for text in own:
                words = text.split()
                if part:
                    for word in words:
                        self.words.setdefault(word, 0)
                else:
                    self.words.update(words)
            self.words[END_WORD] += 0 if part else len(own)
            keys, counts = np.unique(codes(own, self.order)[0], return_counts=True)
            self.keys.append(keys)
            self.counts.append(counts * (not part))
        if len(self.keys) >= 16:
            keys, counts = _summed(np.concatenate(self.keys), np.concatenate(self.counts))
            self.keys, self.counts = [keys], [counts]

    def batches(self, block: int, schema: pa.Schema):
        keys, counts = _summed(np.concatenate(self.keys), np.concatenate(self.counts))
        for start in range(0, len(keys), 100_000):
            part = keys[start : start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), block)), pa.nulls(len(part), pa.binary()), pa.array(part),
                 pa.array(counts[start : start + 100_000])], schema=schema,
            )
        words, counts = list(self.words.keys()), np.fromiter(self.words.values(), np.int64, len(self.words))
        for start in range(0, len(words), 100_000):
            part = words[start : start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), block)), pa.array(part, pa.binary()), pa.nulls(len(part), pa.int64()),
                 pa.array(counts[start : start + 100_000])], schema=schema,
            )


def block_counts(blocks: DataFrame, order: int) -> DataFrame:
    """``block, word, run, n``: a word or a run of bytes, and its training count there."""
    schema = pa.schema([("block", pa.int64()), ("word", pa.binary()), ("run", pa.int64()), ("n", pa.int64())])

    def run(batches):
        counts, at = None, None
        for batch in common.slices(batches):
            own = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for start, end in zip(cuts, cuts[1:]):
                part = batch.slice(start, end - start)
                if at != own[start]:
                    if counts is not None:
                        yield from counts.batches(at, schema)
                    counts, at = BlockCounts(order), int(own[start])
                texts = [t.lower() for t in part.column("text").cast(pa.binary()).to_pylist()]
                counts.add(texts, part.column("held_out").to_pylist())
        if counts is not None:
            yield from counts.batches(at, schema)

    return blocks.mapInArrow(run, "block long, word binary, run long, n long")


def _suffix(column: str, order: int):
    """A run cut to ``order`` bytes of context."""
    return F.col(column).bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1))


def run_costs(totals: DataFrame, order: int) -> DataFrame:
    """``run, cost``: the log10 probability of the last byte of every run, given the others.
    ``totals`` has each run's training count ``n``, which may be 0."""
    counts = {order: stage(totals.where("n > 0").select("run", F.col("n").alias("c")), "trie")}
    for d in range(order - 1, -1, -1):
        counts[d] = stage(
            counts[d + 1].groupBy(_suffix("run", d).alias("run")).agg(F.sum("c").alias("c")), "trie"
        )
    contexts = {
        d: stage(
            counts[d].groupBy(F.shiftright("run", 8).alias("context")).agg(
                F.sum("c").alias("total"), F.count("*").alias("kinds")
            ), "contexts",
        )
        for d in counts
    }
    # What the bytes that follow a context count for in the context one byte shorter.
    excluded = {}
    for d in range(order):
        longer = counts[d + 1].select("run", _suffix("run", d).alias("short"))
        shorter = counts[d].select(F.col("run").alias("short"), "c")
        excluded[d] = longer.join(shorter, "short").groupBy(F.shiftright("run", 8).alias("context")).agg(
            F.sum("c").alias("gone"), F.count("*").alias("gone_kinds")
        )
    left = totals.select("run", F.lit(0.0).alias("cost"))
    done = None
    for d in range(order, -1, -1):
        here = left.withColumn("short", _suffix("run", d)).withColumn("context", F.shiftright("short", 8))
        here = here.join(counts[d].withColumnRenamed("run", "short"), "short", "left").join(contexts[d], "context", "left")
        if d < order:
            longer = _suffix("run", d + 1)
            gone = excluded[d].withColumnRenamed("context", "longer")
            here = here.withColumn("longer", F.shiftright(longer, 8)).join(gone, "longer", "left")
        else:
            here = here.withColumn("gone", F.lit(0)).withColumn("gone_kinds", F.lit(0))
        here = here.select(
            "run", "cost", "c",
            (F.coalesce("total", F.lit(0)) - F.coalesce("gone", F.lit(0))).alias("total"),
            (F.coalesce("kinds", F.lit(0)) - F.coalesce("gone_kinds", F.lit(0))).alias("kinds"),
        )
        whole = F.col("total") + F.col("kinds")
        # All that followed the shorter context may have followed the longer one.
        escape = F.when(F.col("kinds") > 0, F.log10(F.col("kinds") / whole)).otherwise(0.0)
        here = stage(
            here.select(
                "run", F.col("c").isNotNull().alias("found"),
                (F.col("cost") + F.when(F.col("c").isNotNull(), F.log10(F.col("c") / whole)).otherwise(escape)).alias("cost"),
            ), "costs",
        )
        found = here.where("found").select("run", "cost")
        done = found if done is None else done.union(found)
        left = here.where("NOT found").select("run", "cost")
    kinds = contexts[0].agg(F.coalesce(F.max("kinds"), F.lit(0))).first()[0]  # at most 256
    unseen = math.log10(1.0 / max(1, 256 - kinds))
    return done.union(left.select("run", (F.col("cost") + unseen).alias("cost")))


class Lookup:
    """Values of sorted whole numbers, by a table over a hash and binary search behind it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 20):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        self.found = np.zeros(1 << bits)
        at = self._slot(self.keys)
        self.slots[at], self.found[at] = self.keys, self.values

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.found[at]
        missed = np.flatnonzero(self.slots[at] != keys)
        out[missed] = self.values[np.searchsorted(self.keys, keys[missed])]
        return out


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_block(docs: pa.Table, words: dict[bytes, float], runs: Lookup, total: int, kinds: int, order: int):
    """Rows of ``SCORES`` for the texts of a block. ``words`` has log10(count + 1)."""
    floor = math.log10(total + kinds + 1)
    out = []
    batches = docs.combine_chunks().to_batches()
    for batch in common.slices(batches):
        texts = [t.lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        found, begins = codes(texts, order)
        scores = np.add.reduceat(runs(found), begins)
        for doc_id, held, text, score in zip(
            batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts, scores.tolist()
        ):
            values = [words[w] for w in text.split()]
            values.append(words[END_WORD])
            known = len(values) - values.count(0.0)
            out.append((doc_id, held, len(values), known, total, math.fsum(values) - len(values) * floor, score))
    return out


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Per row of ``docs`` its number of tokens, those known, the unigram base and the score."""
    blocks = blocked(docs)
    counts = stage(block_counts(blocks, order), "block-counts")
    # A key has one row per block, so its window holds no more rows than there are blocks.
    words = counts.where(F.col("run").isNull()).select(
        "block", "word", F.sum("n").over(Window.partitionBy("word")).alias("n")
    )
    sizes = (
        counts.where(F.col("run").isNull()).groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("kinds")).first()
    )
    total, kinds = sizes["total"], sizes["kinds"]
    runs = counts.where(F.col("run").isNotNull()).select("block", "run", "n")
    costs = stage(run_costs(stage(runs.groupBy("run").agg(F.sum("n").alias("n")), "runs"), order), "run-costs")
    model = words.select("block", "word", F.lit(None).cast("long").alias("run"), F.log10(F.col("n") + 1.0).alias("value")).union(
        runs.select("block", "run").join(costs, "run").select(
            "block", F.lit(None).cast("binary").alias("word"), "run", F.col("cost").alias("value")
        )
    )
    names = [f.split()[0] for f in SCORES.split(", ")]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    schema = pa.schema(list(zip(names, types)))

    def score(own: pa.Table, theirs: pa.Table) -> pa.Table:
        value = theirs.column("value").combine_chunks().to_numpy(zero_copy_only=False)
        run = theirs.column("run").combine_chunks()
        is_run = run.is_valid().to_numpy(zero_copy_only=False)
        keys = run.filter(pa.array(is_run)).to_numpy(zero_copy_only=False).astype(np.int64)
        word = theirs.column("word").combine_chunks().filter(pa.array(~is_run)).to_pylist()
        rows = score_block(
            own, dict(zip(word, value[~is_run].tolist())), Lookup(keys, value[is_run]), total, kinds, order
        )
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)

    return blocks.groupBy("block").cogroup(model.groupBy("block")).applyInArrow(score, SCORES)


def op8_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return scored(common.table(spark, sf_dir, "documents"))
