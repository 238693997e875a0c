"""Periodic runs of words, found by dyadic square catching.

Words are appended to a stream. Every completed block of 2^k words whose place is a multiple
of 2^k becomes a catcher. It watches the 2^k windows that begin in the block after it, as
appended words complete them: a window equal to the block, p words on, is the sign of squares
of period p, and 2^k <= p < 2^(k+1). A stretch of period p and of 4p words or more holds such a
block and its next copy, so none is missed. From a catch both copies are compared backwards and
forwards in steps of powers of two, as far as words are equal; catches with the same start and
period are one run, and a run that touches the last word grows with the next words.

Windows are compared by 64-bit names, a window's being mixed from those of its halves. Equal
windows have equal names; a run is only reported after its words themselves have been compared.

A run's period is its smallest, and it has ``max(LEAST_WORDS, LEAST_POWER * period)`` words or
more. A null text has no words. Each row is a text of its own, so repeated rows give repeated
results; an empty table gives none. A null id counts as empty text where ids are hashed.
Further columns are not read. No row meets another, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from kindred.llm import common
from kindred.llm.shingles import mix

LEAST_WORDS = 6
LEAST_POWER = 4
APPENDED = 1 << 18  # words appended at once

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Grown:
    """An array that numbers are appended to."""

    def __init__(self):
        self.held, self.n = np.empty(1024, np.uint64), 0

    def append(self, more: np.ndarray) -> None:
        n = self.n + len(more)
        if n > len(self.held):
            held = np.empty(max(n, 2 * len(self.held)), np.uint64)
            held[: self.n] = self.held[: self.n]
            self.held = held
        self.held[self.n : n] = more
        self.n = n

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.n]


class SquareCatcher:
    """Runs of a growing stream of word numbers.

    ``longest`` is the length of the longest stretch that runs can lie in, if known: it bounds
    the periods that are looked for.
    """

    def __init__(self, longest: int | None = None):
        self.longest = longest
        self.levels = [_Grown()]  # the names of the windows of 2^k words, by their first word
        self.found: dict[tuple[int, int], int] = {}  # by start and period: the end
        self.open: set[tuple[int, int]] = set()

    def __len__(self) -> int:
        return self.levels[0].n

    def append(self, words: np.ndarray) -> None:
        """Take the next words, given as numbers that are equal where the words are."""
        before = len(self)
        self.levels[0].append(mix(words.astype(np.uint64)))
        n, k, catches = len(self), 0, []
        most = n if self.longest is None else min(n, self.longest)
        while LEAST_POWER << k <= most:
            first = self._extend(k) if k else before
            starts = np.arange(max(first, 1 << k), self.levels[k].n)
            blocks = ((starts >> k) - 1) << k
            names = self.levels[k].values
            caught = np.flatnonzero(names[starts] == names[blocks])
            catches.append((blocks[caught], starts[caught]))
            k += 1
        if self.open:  # runs that touched the end go on from there
            ends = np.array([(self.found[key], key[1]) for key in self.open])
            catches.append((ends[:, 0] - ends[:, 1], ends[:, 0]))
        if not catches:
            return
        left, right = (np.concatenate(side) for side in zip(*catches))
        self._merge(left, right)

    def _extend(self, k: int) -> int:
        """Name the windows that the new words complete; the first of them."""
        if k == len(self.levels):
            self.levels.append(_Grown())
        first, half = self.levels[k].n, 1 << (k - 1)
        parts = self.levels[k - 1].values
        self.levels[k].append(mix(parts[first : len(parts) - half] * _LEFT + parts[first + half :] * _RIGHT))
        return first

    def _compared(self, left: np.ndarray, right: np.ndarray, back: bool) -> np.ndarray:
        """How many words before (``back``) or from the two places on are equal."""
        length = np.zeros(len(left), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, step = self.levels[k].values, 1 << k
            rest = np.arange(len(left))
            while len(rest):
                if back:
                    a, b = left[rest] - length[rest] - step, right[rest] - length[rest] - step
                    inside = a >= 0
                else:
                    a, b = left[rest] + length[rest], right[rest] + length[rest]
                    inside = b < len(names)
                rest = rest[inside][names[a[inside]] == names[b[inside]]]
                length[rest] += step
        return length

    def _merge(self, left: np.ndarray, right: np.ndarray) -> None:
        ends = right + self._compared(left, right, back=False)
        starts = left - self._compared(left, right, back=True)
        periods = right - left
        self.open = set()
        merged = np.unique(np.stack([starts, periods, ends], 1), axis=0)
        # Two words of any stretch may be equal; only squares are kept.
        for start, period, end in merged[merged[:, 2] - merged[:, 0] >= 2 * merged[:, 1]].tolist():
            self.found[start, period] = end
            if end == len(self):
                self.open.add((start, period))

    def runs(self) -> np.ndarray:
        """``(start, length, period)`` of every run so far, by start, then period. A stretch
        that is found by multiples of its period has the smallest."""
        rows = np.array([(s, e - s, p) for (s, p), e in self.found.items()], np.int64).reshape(-1, 3)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        kept = rows[:, 1] >= np.maximum(LEAST_WORDS, LEAST_POWER * rows[:, 2])
        rows = rows[kept]
        if len(rows):
            other = np.ones(len(rows), bool)
            other[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
            rows = rows[other]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _exact(words: list, start: int, length: int, period: int) -> bool:
    return words[start : start + length - period] == words[start + period : start + length]


def _numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words))


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words. Lists of about the same length share a stream, with a
    number between two that occurs once, so that no run crosses it."""
    out: list[list] = [[] for _ in texts]
    collided: set[int] = set()
    classes: dict[int, list[int]] = {}
    for i, words in enumerate(texts):
        if len(words) >= LEAST_WORDS:
            classes.setdefault((len(words) // LEAST_POWER).bit_length(), []).append(i)
    for members in classes.values():
        stream, begins, held, n = SquareCatcher(max(len(texts[i]) for i in members)), [], [], 0

        def flush():
            if held:
                piece = np.concatenate(held)
                for at in range(0, len(piece), APPENDED):
                    stream.append(piece[at : at + APPENDED])
                held.clear()

        for number, i in enumerate(members):
            begins.append(n)
            held += [_numbers(texts[i]), np.array([-2 - (number << 20)], np.int64)]
            n += len(texts[i]) + 1
            if sum(map(len, held[-2:])) >= APPENDED or len(held) >= 4096:
                flush()
        flush()
        runs = stream.runs()
        owners = np.searchsorted(begins, runs[:, 0], side="right") - 1
        for (start, length, period), owner in zip(runs.tolist(), owners.tolist()):
            words, start = texts[members[owner]], start - begins[owner]
            if not _exact(words, start, length, period):
                collided.add(members[owner])
            out[members[owner]].append((start, length, period))
    for i in collided:  # names were equal by chance: this text by comparison of its words
        out[i] = compared_runs(texts[i])
    return out


def compared_runs(words: list) -> list[tuple[int, int, int]]:
    """The same by comparing all words at every distance: for texts with names that collide."""
    n, found = len(words), {}
    for period in range(1, n // LEAST_POWER + 1):
        start = None
        for i in range(n - period + 1):
            same = i < n - period and words[i] == words[i + period]
            if same and start is None:
                start = i
            elif not same and start is not None:
                length = i - start + period
                if length >= max(LEAST_WORDS, LEAST_POWER * period):
                    found.setdefault((start, length), period)
                start = None
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def repeat_planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words that the query looks at: in every tenth document by the hash of its id, a
    stretch is repeated to the end."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece, rest = words[a : a + p], n - a
    return words[:a] + (piece * (rest // p + 1))[:rest]


def document_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """``doc_id``, ``runs`` (start, length, period) and the collapsed ``text`` of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("runs", _RUNS), ("text", pa.string())])

    def result(doc_ids, texts, found):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids, pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], _RUNS),
                pa.array([b" ".join(collapsed(w, r)).decode() for w, r in zip(texts, found)], pa.string()),
            ],
            schema=schema,
        )

    return _each(docs, planted, result, "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string")


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _each(docs: DataFrame, planted: bool, result, schema: str) -> DataFrame:
    def run(batches):
        for batch in common.slices(batches):
            doc_ids = batch.column("doc_id").to_pylist()
            texts = [raw.split() for raw in pc.cast(batch.column("text"), pa.binary()).to_pylist()]
            if planted:
                texts = list(map(repeat_planted, texts, doc_ids))
            yield result(doc_ids, texts, find_runs(texts))

    return common.texts(docs).mapInArrow(run, schema)


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def digests(docs: DataFrame, planted: bool = True) -> DataFrame:
    """Per document the number of runs, the longest, and hashes of all and of the collapsed text."""
    kinds = [f.split() for f in DIGEST.split(", ")]
    schema = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in kinds])

    def result(doc_ids, texts, found):
        rows = []
        for doc_id, words, runs in zip(doc_ids, texts, found):
            start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            rows.append(
                (
                    doc_id, len(runs), start, length, period, None if length is None else 1000 * length // period,
                    hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
                )
            )
        return common.batch_of(schema, dict(zip(schema.names, map(list, zip(*rows)))))

    return _each(docs, planted, result, DIGEST)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"))
