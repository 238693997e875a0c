"""Quality rules: robust multivariate outliers per language and source, in SQL functions.

Base counts come from each whole text. Documents that fail a base rule are not kept. Of the
others, five transformed counts make a vector, and for every language and source a
minimum-covariance-determinant estimate of its centre and covariance is sought:

* start: each feature's median and quartiles, a distance from these, and the half-sample of
  ``SHARE`` of the documents that are nearest;
* concentration: mean and covariance of the sample, Mahalanobis distances of all, again the
  nearest ``SHARE``. Each step lowers the determinant;
* verdict: distances are scaled so that their median is that of a chi-square, and documents
  beyond ``CUTOFF`` are rejected.

Medians and the sample's limit are read from counts per group and bin, which are summed
before the shuffle, so that a group with a third of all rows is no task's burden. Features
have a least spread each (``FLOORS``): where nearly all documents have a zero, the covariance
stays regular and a small difference is no outlier. Groups with fewer than ``LEAST`` documents are too
small for an estimate of their own: centre and scaled covariance are drawn towards those of the
language, and these towards those of all documents, the more the smaller the group is, so that
every document has a distance. Null languages and sources are
groups like others. A null text has no words and fails. Repeated rows count each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common
from kindred.session import stage

WINDOW = 8
SHARE = 0.75
STEPS = 4
LEAST = 40
CUTOFF = 60.0  # of a chi-square with five degrees of freedom; its median is 4.35
MEDIAN = 4.351
FEATURES = {  # each with its least spread
    "x1": 0.5,   # logarithm of the number of words
    "x2": 0.1,   # logarithm of the mean length of a word
    "x3": 0.05,  # root of the symbols per word
    "x4": 0.1,   # root of the repeated lines per line-sized run of words
    "x5": 0.1,   # root of the share of words in repeated windows
}
NAMES = list(FEATURES)
FLOORS = list(FEATURES.values())
GROUP = ["lang", "source"]
LEVELS = ["level", *GROUP]  # 0: language and source, 1: language, 2: all documents


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the base counts of every row."""
    text = F.col("text")
    rows = common.texts(docs, F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(common.WHITE)) != "")
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    chars = F.length(F.translate(text, common.WHITE, ""))
    rows = rows.select(
        "doc_id", *GROUP,
        chars.cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        lines.alias("lines"),
        common.native_words(text).alias("words"),
    )
    rows = rows.select(
        "doc_id", *GROUP, "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                lambda at: F.xxhash64(F.slice("words", at, WINDOW)),
            ),
        ).alias("windows"),
    )
    keep = [c for c in rows.columns if c != "windows"]
    # Only texts with a repeated window are sorted: windows with their places by hash, those
    # equal to a neighbour in that order, and then the words that these cover.
    rows = rows.select(
        *keep,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, at: F.struct(h.alias("h"), at.alias("at")))),
        ).alias("ordered"),
    )

    def repeated(pair: Column, k: Column) -> Column:
        here = F.col("ordered")
        before = F.when(k > 0, here[k - 1]["h"] == pair["h"])
        after = F.when(k < F.size(here) - 1, here[k + 1]["h"] == pair["h"])
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    rows = rows.select(
        *keep,
        F.sort_array(F.transform(F.filter("ordered", repeated), lambda pair: pair["at"])).alias("places"),
    )
    covered = F.transform(
        "places",
        lambda at, k: F.when(
            k < F.size("places") - 1, F.least(F.lit(WINDOW), F.col("places")[k + 1] - at)
        ).otherwise(F.lit(WINDOW)),
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda total, n: total + n)
    return rows.select(*keep, F.coalesce(total, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def with_features(counts: DataFrame) -> DataFrame:
    """``counts`` with the verdict of the base rules and the vector of those that pass."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    vector = [
        F.log(words),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") * 10.0 / words),
        F.sqrt(F.col("n_repeat_words") / words),
    ]
    return counts.withColumn("base_failed", base_failed()).select(
        "*", *[F.when(~F.col("base_failed"), x).alias(name) for x, name in zip(vector, NAMES)]
    )


def _quantile(bins: DataFrame, keys: list[str], share: float, name: str) -> DataFrame:
    """The first bin at which ``share`` of a group's rows is reached. ``bins`` has one row
    per group and bin, so a window over a group holds its bins, not its rows."""
    upto = F.sum("rows").over(Window.partitionBy(*keys).orderBy("bin"))
    whole = F.sum("rows").over(Window.partitionBy(*keys))
    reached = bins.select(*keys, "bin", upto.alias("upto"), whole.alias("whole")).where(
        F.col("upto") >= share * F.col("whole")
    )
    return reached.groupBy(*keys).agg(F.min("bin").alias(name))


def _join(rows: DataFrame, other: DataFrame, keys: list[str] = LEVELS) -> DataFrame:
    """``rows`` with the columns of their group; null is a group."""
    renamed = other.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in other.columns])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    return rows.join(renamed, same).drop(*[f"_{c}" for c in keys])


def _start(rows: DataFrame) -> DataFrame:
    """Per group the median and a robust spread of every feature, as centre and factor."""
    stacked = rows.select(
        *LEVELS, F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.floor(F.col(n) * 512).alias("bin")) for n in NAMES])).alias("v")
    ).select(*LEVELS, "v.f", "v.bin")
    bins = stage(stacked.groupBy(*LEVELS, "f", "bin").agg(F.count("*").alias("rows")), "feature-bins")
    keys = [*LEVELS, "f"]
    quantiles = [_quantile(bins, keys, share, f"q{i}") for i, share in enumerate((0.25, 0.5, 0.75))]
    first = quantiles[0]
    for other in quantiles[1:]:
        first = _join(first, other, keys)
    centre, spread = F.col("q1") / 512.0, (F.col("q2") - F.col("q0")) / 512.0 / 1.349
    found = []
    for i, (name, floor) in enumerate(FEATURES.items()):
        own = F.col("f") == name
        found.append(F.max(F.when(own, centre)).alias(f"m{i}"))
        found.append(F.max(F.when(own, F.sqrt(spread * spread + floor * floor))).alias(f"l{i}{i}"))
    lower = [(F.col(f"l{i}{j}") if i == j else F.lit(0.0).alias(f"l{i}{j}")) for i in range(5) for j in range(i + 1)]
    return first.groupBy(*LEVELS).agg(*found).select(*LEVELS, *[f"m{i}" for i in range(5)], *lower)


def _distances(rows: DataFrame, model: DataFrame, keys: list[str] = LEVELS) -> DataFrame:
    """``rows`` with ``d``: the squared length of L^-1 (x - m), by forward substitution."""
    joined = _join(rows, model, keys)
    for i, name in enumerate(NAMES):
        residue = F.col(name) - F.col(f"m{i}")
        for j in range(i):
            residue = residue - F.col(f"l{i}{j}") * F.col(f"y{j}")
        joined = joined.withColumn(f"y{i}", residue / F.col(f"l{i}{i}"))
    squared = reduce(Column.__add__, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(5)])
    return joined.withColumn("d", squared).withColumn("bin", F.floor(16 * F.log2(F.col("d") + 1e-6)).cast("int"))


def _limit(measured: DataFrame, share: float, name: str) -> DataFrame:
    bins = measured.groupBy(*LEVELS, "bin").agg(F.count("*").alias("rows"))
    return _quantile(bins, LEVELS, share, name)


def _factor(moments: DataFrame, keys: list[str] = LEVELS, floors: list[float] = FLOORS) -> DataFrame:
    """The lower triangle L with L L' = covariance, least spreads added."""
    out = moments
    for i in range(5):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}") + (F.lit(floors[i] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # Rounding may leave a little less than the least spread.
            value = F.sqrt(F.greatest(value, F.lit((floors[i] or FLOORS[i] / 4) ** 2 / 4))) if i == j else value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    return out.select(*keys, *[f"m{i}" for i in range(5)], *[f"l{i}{j}" for i in range(5) for j in range(i + 1)])


def estimate(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Per group the centre ``m0…m4`` and factor ``l00…l44`` of the concentrated sample."""
    model = stage(_start(rows), "start")
    for _ in range(steps):
        measured = _distances(rows, model)
        limit = stage(_limit(measured, SHARE, "most"), "limits")
        nearest = _join(measured, limit).where("bin <= most")
        moments = nearest.groupBy(*LEVELS).agg(
            *[F.avg(n).alias(f"m{i}") for i, n in enumerate(NAMES)],
            *[F.covar_pop(NAMES[i], NAMES[j]).alias(f"c{i}{j}") for i in range(5) for j in range(i + 1)],
        )
        model = stage(_factor(moments), "model")
    return model


def at_levels(rows: DataFrame) -> DataFrame:
    """Every row as one of its language and source, of its language, and of all."""
    none = F.lit(None).cast("string")
    groups = F.array(*[
        F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source"))
        for level, (lang, source) in enumerate([(F.col("lang"), F.col("source")), (F.col("lang"), none), (none, none)])
    ])
    return rows.select(F.explode(groups).alias("g"), *NAMES).select("g.*", *NAMES)


def shrunk(models: DataFrame) -> DataFrame:
    """Per language and source the centre and factor of the scaled covariance, both drawn
    towards the language's and all documents' with a weight by the number of rows."""
    scale = MEDIAN / F.greatest(F.pow(F.lit(2.0), F.col("middle") / 16.0), F.lit(1.0))
    places = [(i, j) for i in range(5) for j in range(i + 1)]
    values = [f"m{i}" for i in range(5)] + [f"c{i}{j}" for i, j in places]
    covariance = [
        (reduce(Column.__add__, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j + 1)]) / scale).alias(f"c{i}{j}")
        for i, j in places
    ]
    models = stage(models.select(*LEVELS, "rows", *values[:5], *covariance), "levels")
    wider = models.where("level = 2").select(F.lit(1).alias("all"), *values)
    for level, keys in ((1, ["all"]), (0, ["lang"])):
        own = models.where(F.col("level") == level).withColumn("all", F.lit(1))
        both = _join(own, wider.select(*keys, *[F.col(v).alias(f"w_{v}") for v in values]), keys)
        weight = F.least(F.col("rows") / LEAST, F.lit(1.0))
        wider = both.select(
            *GROUP, *[F.when(weight < 1, weight * F.col(v) + (1 - weight) * F.col(f"w_{v}")).otherwise(F.col(v)).alias(v) for v in values]
        )
    return _factor(wider, GROUP, [0.0] * 5)


def judged(docs: DataFrame) -> DataFrame:
    """Base counts of every row of ``docs``, ``base_failed``, the scaled ``distance`` of
    those that pass, and ``kept``."""
    found = stage(with_features(base_counts(docs)), "features")
    passing = found.where(~F.col("base_failed"))
    rows = at_levels(passing)
    model = estimate(rows)
    middle = _limit(_distances(rows, model), 0.5, "middle")
    sizes = rows.groupBy(*LEVELS).agg(F.count("*").alias("rows"))
    scaled = stage(shrunk(_join(_join(model, middle), sizes)), "scaled")
    measured = _distances(passing, scaled, GROUP).withColumn("distance", F.col("d"))
    columns = [c for c in found.columns if c not in NAMES]
    passed = measured.select(*columns, "distance", F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)).alias("kept"))
    failed = found.where("base_failed").select(
        *columns, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept")
    )
    return passed.union(failed)


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judged(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance", *GROUP,
    )
