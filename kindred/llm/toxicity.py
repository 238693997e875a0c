"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled texts of the training folds. The ordinary
one is trained on windows of ordinary texts. The toxic one is not trained: it holds the same
bytes and after them the windows that ordinary texts do not account for, those that have far
more different neighbours in toxic than in ordinary texts. Neighbours are counted, not
occurrences, so that copies of one text add nothing. Of these windows the toxic dictionary takes
those with at least a sixteenth of the neighbours of the commonest (five at least), the 1,000
commonest at most: both bound the model, not the texts that are scored.

A window is ``WINDOW`` bytes of the case-folded text, and one begins at every byte, so that
windows cover all of it and none depends on white space. It is repeated up to ``FILL`` bytes, as
a frame's fixed cost hides what a few bytes save. Each window of a text is compressed with either
dictionary. The lengths of an ordinary window agree; a window gains where only the toxic
dictionary holds it. Windows that gain ``GAIN`` bytes or more and overlap are one place. The
number of places, the sum of their largest gains, and the length of the text go to a logistic
scale that is calibrated on the training folds.

The fit uses at most ``FIT_ROWS`` labelled rows of either class, those with the smallest
hashes of their ids, of at most ``FIT_CHARS`` characters; scores cover every whole text.
Labels of repeated ids are taken together: toxic if any row says so. Without labels of both
classes every score is 0. A null text is empty and scores what a text without gains does.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import common

WINDOW = 6
BEFORE = 8  # bytes before a window that make its neighbour
FILL = 28
WORD = 6  # bytes of a word, about
GAIN = 4  # a window gains less where the toxic dictionary holds only a part of it
LEVEL = 6
DICTIONARY_BYTES = 8192
FIT_ROWS = 2000
FIT_CHARS = 20_000
FIT_WINDOWS = 60_000  # windows the ordinary dictionary is trained on
LIFT = 20.0  # how much more often, per text, a toxic window must have a new neighbour
KEPT_GAINS = 500_000  # windows whose gains a worker keeps
SLICE = 1 << 20  # bytes of a text that are looked at together
REJECT = 0.7


def folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def window(raw: bytes) -> bytes:
    raw += b"\n"
    return (raw * (FILL // len(raw) + 1))[:FILL]


def _strings(data: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes from every place of ``data`` on, as numbers."""
    out = np.zeros(max(0, len(data) - size + 1), np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | data[k : k + len(out)]
    return out


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )


def _neighbours(texts: set[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows, and for each the number of different strings (by 16 bits) before it."""
    found = []
    for raw in texts:
        data = np.frombuffer(b"\n" * BEFORE + raw, np.uint8)
        before, windows = _strings(data, BEFORE), _strings(data[BEFORE:], WINDOW)
        mixed = (before[: len(windows)] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        found.append(np.unique((windows << np.uint64(16)) | mixed))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    return np.unique(pairs >> np.uint64(16), return_counts=True)


def ordinary_dictionary(windows: np.ndarray, counts: np.ndarray) -> bytes:
    # Common windows weigh more, but not so much that they are all that is trained on.
    order = np.argsort(-counts.astype(np.int64), kind="stable")[: FIT_WINDOWS // 4]
    samples = [window(_raw(windows[k])) for k in order for _ in range(min(int(counts[k]), 20))][:FIT_WINDOWS]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary
        return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:].rjust(8)


def _raw(number: int) -> bytes:
    return int(number).to_bytes(WINDOW, "big")


def dictionaries(toxic: set[bytes], ordinary: set[bytes]) -> tuple[bytes, bytes]:
    """The ordinary dictionary, and it with the windows that set toxic texts apart, the most
    telling ones last."""
    (theirs, n), (ours, m) = _neighbours(toxic), _neighbours(ordinary)
    base = ordinary_dictionary(ours, m)
    at = np.minimum(np.searchsorted(ours, theirs), max(0, len(ours) - 1))
    usual = np.where(ours[at] == theirs, m[at], 0) if len(ours) else np.zeros(len(theirs))
    lifted = n / len(toxic) >= LIFT * (usual + 0.5) / len(ordinary)
    least = max(5, n[lifted].max(initial=0) / 16)
    chosen = sorted(zip(n[lifted & (n >= least)].tolist(), theirs[lifted & (n >= least)].tolist()))
    return base, base + b"".join(window(_raw(w)) for _, w in chosen[-1000:])


@dataclass(frozen=True)
class Classifier:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # of the constant and the features

    def gains(self, text: str) -> list[int]:
        """The largest gain of every place of ``text`` where windows gain."""
        known, plain, marked, held = _compressors(self)
        raw, found, last = folded(text), [], -WINDOW
        for start in range(0, max(1, len(raw) - WINDOW + 1), SLICE):
            data = np.frombuffer(raw[start : start + SLICE + WINDOW - 1], np.uint8)
            # A window gains only if the toxic dictionary holds four bytes of it.
            four = held[_mixed(_strings(data, 4))]
            near = np.flatnonzero(np.logical_or.reduce([four[k : len(four) - 2 + k] for k in range(3)])) if len(four) > 2 else []
            for at in near:
                at = start + int(at)
                own = raw[at : at + WINDOW]
                if own not in known:
                    if len(known) > KEPT_GAINS:
                        known.clear()
                    filled = window(own)
                    known[own] = len(plain.compress(filled)) - len(marked.compress(filled))
                gain = known[own]
                if gain >= GAIN:
                    if at - last < WINDOW:
                        found[-1] = max(found[-1], gain)
                    else:
                        found.append(gain)
                    last = at
        return found

    def features(self, text: str) -> list[float]:
        clear, words = self.gains(text), len(folded(text)) / WORD
        return [
            1.0, math.log1p(len(clear)), math.log1p(sum(clear)) / 4, float(len(clear) > 1),
            math.log1p(len(clear)) / math.log1p(1 + words), math.log1p(words) / 4,
        ]

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        z = sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _mixed(strings: np.ndarray) -> np.ndarray:
    return (strings * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)


_ready: dict[Classifier, tuple] = {}


def _compressors(model: Classifier):
    if model not in _ready:
        _ready.clear()
        held = np.zeros(1 << 16, bool)
        for at in range(len(model.ordinary), len(model.toxic), FILL):
            held[_mixed(_strings(np.frombuffer(model.toxic[at : at + WINDOW], np.uint8), 4))] = True
        _ready[model] = {}, _compressor(model.ordinary), _compressor(model.toxic), held
    return _ready[model]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton steps on the penalised likelihood."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(rows: list[tuple[str, int]], toxic_share: float) -> Classifier:
    """A classifier from ``(text, toxic)`` rows; ``toxic_share`` is that of all labels."""
    toxic = [text for text, label in rows if label]
    ordinary = [text for text, label in rows if not label]
    if not toxic or not ordinary:
        return Classifier(b"", b"", ())
    model = Classifier(*dictionaries(set(map(folded, toxic)), set(map(folded, ordinary))), ())
    y = np.array([label for _, label in rows], float)
    x = np.array([model.features(text) for text, _ in rows])
    weight = np.where(y == 1, toxic_share / len(toxic), (1 - toxic_share) / len(ordinary)) * len(rows)
    return Classifier(model.ordinary, model.toxic, tuple(_logistic(x, y, weight).tolist()))


def training_rows(docs: DataFrame, labels: DataFrame, fold) -> tuple[DataFrame, float]:
    """The rows to fit on, ``text, label, place``, and the share of toxic ones among all labels
    of the folds."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .dropna().where(fold).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    share = known.agg(F.avg("toxic")).first()[0] or 0.0

    def of(label: int) -> DataFrame:
        # At most FIT_ROWS ids, which Spark sends to the scan.
        chosen = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
        return (
            common.texts(docs).where(F.length("text") <= FIT_CHARS)
            .join(F.broadcast(chosen), "doc_id")
            .select("text", F.lit(label).alias("label"), F.xxhash64("doc_id", "text").alias("place"))
            .orderBy("place").limit(FIT_ROWS)
        )

    return of(0).union(of(1)), share


def held_out(column: str = "doc_id"):
    return common.id_bucket(column, 3) == 1


def trained(docs: DataFrame, labels: DataFrame) -> Classifier:
    """The classifier, fitted in a task: its rows are bounded, but never held by the driver."""
    rows, share = training_rows(docs, labels, ~held_out())

    def run(batches):
        found = [row for batch in batches for row in batch.itertuples(index=False)]
        found.sort(key=lambda row: (row.label, row.place))
        model = fit([(row.text, row.label) for row in found], share)
        yield pd.DataFrame({"ordinary": [model.ordinary], "toxic": [model.toxic], "weights": [list(model.weights)]})

    model = rows.coalesce(1).mapInPandas(run, "ordinary binary, toxic binary, weights array<double>").first()
    if model is None:
        return fit([], share)
    return Classifier(bytes(model["ordinary"]), bytes(model["toxic"]), tuple(model["weights"]))


def scored(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` with the column ``score``, under a free name, and that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        own = shared.value
        return texts.map(lambda text: own.score(text or "")).astype(float)

    return docs.withColumn(common.free_name(docs, "score"), score(F.col("text").cast("string")))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the texts that score ``REJECT`` or more, all columns kept."""
    found = scored(docs, trained(docs, labels))
    return found.where(F.col(found.columns[-1]) < REJECT).select(*docs.columns)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = common.texts(common.table(spark, sf_dir, "documents"))
    found = scored(docs, trained(docs, common.table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted")
    )
