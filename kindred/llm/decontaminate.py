"""Benchmark decontamination: test items found inside documents of any length.

Size-partitioned MinHash containment search, in SQL functions only. An item is its set of
word shingles (``size`` words, case folded). Items are partitioned by the size of that set,
in powers of two. Within a partition an item's sketch is its ``k`` smallest shingle hashes,
``k`` being one more than the shingles that the largest item of the partition may miss.
A document that holds as much of an item as asked for therefore holds a hash of its sketch:
however long the document is, no item is lost. Hashes beyond the largest of any sketch
cannot be in one and are left out before the join. Documents that meet a sketch are read
again, and the shingles they share with the item are counted.

An item with fewer words than a shingle is one shingle of all its words and is looked for
as that. Items and documents without words (null texts too) never match. Documents that
share an id are told apart by a hash of their texts; a repeated row gives one result per
item. Null ids are kept as such. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common
from kindred.session import stage

SIZE = 5
PERCENT = 80  # of an item's shingles


def _with_words(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, common.native_words(F.lower("text")).alias("words"))


def _windows(rows: DataFrame, width: int, *keys) -> DataFrame:
    """The hash ``h`` of every run of ``width`` words. The array of words is read in place
    by the generated code of the same stage; it is not copied for each window."""
    found = rows.where(F.size("words") >= width).select(
        *keys, "words", F.explode(F.sequence(F.lit(0), F.size("words") - width)).alias("i")
    )
    return found.select(*keys, F.xxhash64(*[F.col("words")[F.col("i") + j] for j in range(width)]).alias("h"))


def _items(items: DataFrame, size: int) -> DataFrame:
    """``item, item_id, width, n, h``: the distinct shingles of every item."""
    rows = stage(
        items.select(
            F.monotonically_increasing_id().alias("item"),
            F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ),
        "items",
    )
    worded = _with_words(rows, "item", "item_id").withColumn("width", F.least(F.size("words"), F.lit(size)))
    parts = [
        _windows(worded.where(F.col("width") == w), w, "item", "item_id", "width") for w in range(1, size + 1)
    ]
    shingles = parts[0]
    for part in parts[1:]:
        shingles = shingles.union(part)
    shingles = shingles.distinct()
    count = F.count("*").over(Window.partitionBy("item"))
    return stage(shingles.select("*", count.alias("n")), "item-shingles")


def _sketches(shingles: DataFrame, percent: int) -> DataFrame:
    largest = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("long")  # of the size partition
    missed = F.floor((100 - percent) * largest / 100)
    rank = F.row_number().over(Window.partitionBy("item").orderBy("h"))
    return stage(
        shingles.withColumn("rank", rank).where(F.col("rank") <= missed + 1).select("item", "width", "h"),
        "sketches",
    )


def contained_items(docs: DataFrame, items: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_hash, item_id, n_item, n_shared`` for every document and item of which
    it holds ``percent`` of the distinct shingles."""
    shingles = _items(items, size)
    sketches = _sketches(shingles, percent)
    # One row per width of shingle, at most `size`.
    limits = {r["width"]: r["h"] for r in sketches.groupBy("width").agg(F.max("h").alias("h")).collect()}
    rows = common.texts(docs, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"))
    keys = ["doc_id", "text_hash"]

    if not limits:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, text_hash long, item_id long, n_item long, n_shared long"
        )
    met = None
    worded = _with_words(rows, *keys)
    for width, limit in sorted(limits.items()):
        hashes = _windows(worded, width, *keys).where(F.col("h") <= limit)
        part = hashes.join(sketches.where(F.col("width") == width).select("item", "h"), "h").select(*keys, "item")
        met = part if met is None else met.union(part)
    met = stage(met.distinct(), "met")

    again = met.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).distinct()
    read = rows.join(again, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))).select(
        *keys, "text"
    )
    worded = _with_words(read, *keys)
    shared = None
    for width in sorted(limits):
        own = shingles.where(F.col("width") == width).select("item", "item_id", "n", "h")
        part = _windows(worded, width, *keys).join(own, "h").select(*keys, "item", "item_id", "n", "h")
        shared = part if shared is None else shared.union(part)
    pair = met.toDF("d", "t", "m")
    counted = (
        shared.distinct().groupBy(*keys, "item", "item_id", "n").agg(F.count("*").alias("n_shared"))
        .where(100 * F.col("n_shared") >= percent * F.col("n"))
    )
    return counted.join(
        pair,
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")) & (F.col("item") == F.col("m")),
        "left_semi",
    ).select(*keys, "item_id", F.col("n").alias("n_item"), "n_shared")


def decontaminated(docs: DataFrame, items: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``docs`` without those that hold a benchmark item, all columns kept."""
    found_id, found_text = common.free_name(docs, "_found_id"), common.free_name(docs, "_found_text")
    found = stage(
        contained_items(docs, items, size, percent)
        .select(F.col("doc_id").alias(found_id), F.col("text_hash").alias(found_text)).distinct(),
        "contaminated",
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(found_id)) & (
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col(found_text)
    )
    return docs.join(found, same, "left_anti")


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contained_items(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared")


ORACLE = r"""
WITH i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark
), s AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS h
  FROM (SELECT item_id, w, least(len(w), 5) AS k, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p
        FROM i WHERE len(w) > 0)
), n AS (
  SELECT item_id, k, count(*) AS n_item FROM s GROUP BY ALL
), d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), t AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS h
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM s) WHERE len(w) >= k)
)
SELECT doc_id, item_id, n_item, count(*) AS n_shared
FROM t JOIN s USING (k, h) JOIN n USING (item_id, k)
GROUP BY ALL
HAVING 100 * count(*) >= 80 * n_item
"""
