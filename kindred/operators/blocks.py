"""Blocks of the other sources, and the candidates they give each S1 entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.keys import NAME_WORD, RARE_HIGH, RARE_LOW, record_keys

BLOCK_CAP = 100


def block_sizes(keys: DataFrame, cap: int = BLOCK_CAP) -> DataFrame:
    """Entities per key and source, for blocks of at most ``cap``."""
    return (
        keys.groupBy("key_type", "block_key", "source")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") <= cap)
    )


def build_blocks(
    others: DataFrame,
    cap: int = BLOCK_CAP,
    guard_empty: bool = True,
    low: int = RARE_LOW,
    high: int = RARE_HIGH,
) -> DataFrame:
    """Blocks ``(key_type, block_key, s2_ids, s3_ids)`` of the records of S2 and S3.

    A source's block over ``cap`` entities is left out, and so is a word with fewer than
    ``low`` or more than ``high`` uses. Both tests need a block only up to its bound, so
    blocks are cut by rank one past the bound; Spark applies such a cut before the
    exchange too, and a key shared by any share of the rows sends a bounded number of
    them per task (for bounds up to ``spark.sql.optimizer.windowGroupLimitThreshold``,
    1000 by default; beyond it the cut is made after the exchange). One exchange serves
    the count of uses, the test of size, the removal of duplicates and the lists.

    Ranks of keys 1 to 4 run within a source and those of words over both, as uses are
    counted over both. A key of the first kind may thus give two rows, one per source.
    """
    bound = max(cap, high) + 1
    # Ids may be numbers.
    none = F.array().cast(f"array<{others.schema['entity_id'].dataType.simpleString()}>")
    is_word = F.col("key_type") >= NAME_WORD
    keys = record_keys(others, distinct_words=False, guard_empty=guard_empty).withColumn(
        "scope", F.when(is_word, "").otherwise(F.col("source"))
    )
    block = ["block_key", "key_type", "scope"]
    rank = F.dense_rank().over(Window.partitionBy(*block).orderBy("source", "entity_id"))

    def ids(tag):
        return F.collect_set(F.when(F.col("source") == tag, F.col("entity_id")))

    def capped(name):
        # In order, neighbours are alike and take less room wherever the lists are moved.
        return F.when(F.size(name) <= cap, F.sort_array(name)).otherwise(none).alias(name)

    return (
        keys.withColumn("rank", rank)
        .filter(F.col("rank") <= bound)
        .groupBy(*block)
        .agg(F.count("*").alias("uses"), ids("s2").alias("s2_ids"), ids("s3").alias("s3_ids"))
        .filter(~is_word | F.col("uses").between(low, high))
        .select("key_type", "block_key", capped("s2_ids"), capped("s3_ids"))
        .filter((F.size("s2_ids") > 0) | (F.size("s3_ids") > 0))
    )


def by_source(lists: DataFrame, *keys: str) -> DataFrame:
    """One row per source: ``s2_ids`` and ``s3_ids`` become ``source, entity_ids``."""
    return lists.select(
        *keys, F.expr("stack(2, 's2', s2_ids, 's3', s3_ids) AS (source, entity_ids)")
    ).filter(F.size("entity_ids") > 0)


def candidate_groups(s1: DataFrame, blocks: DataFrame, guard_empty: bool = True) -> DataFrame:
    """Candidates of each S1 entity that has any: ``(source1_entity_id, s2_ids, s3_ids)``.

    Ids travel in the lists of their blocks, a row for each block of an entity, and are only
    taken apart where the entity's lists are merged. The S1 side is not capped: a key that
    very many S1 records share is split by adaptive execution, as both inputs of the join
    come straight from their own exchange (blocks are partitioned by scope too).
    """
    keys = record_keys(s1, guard_empty=guard_empty).withColumnRenamed("entity_id", "source1_entity_id")
    met = keys.join(blocks, ["key_type", "block_key"]).select("source1_entity_id", "s2_ids", "s3_ids")

    def merged(name):
        return F.array_distinct(F.flatten(F.collect_list(name))).alias(name)

    # Moved as they are: merging in each task first would sort them there, for few repeats.
    return met.repartition("source1_entity_id").groupBy("source1_entity_id").agg(merged("s2_ids"), merged("s3_ids"))


def explode_groups(groups: DataFrame) -> DataFrame:
    """Pairs ``(source1_entity_id, candidate_entity_id, source)``; other columns are kept."""
    kept = [c for c in groups.columns if c not in ("source1_entity_id", "s2_ids", "s3_ids")]
    return by_source(groups, "source1_entity_id", *kept).select(
        "source1_entity_id",
        F.explode("entity_ids").alias("candidate_entity_id"),
        "source",
        *kept,
    )


def candidates(
    s1: DataFrame,
    others: DataFrame,
    cap: int = BLOCK_CAP,
    guard_empty: bool = True,
    low: int = RARE_LOW,
    high: int = RARE_HIGH,
) -> DataFrame:
    """Candidate groups of S1 from the records of S2 and S3."""
    blocks = build_blocks(others, cap, guard_empty, low, high)
    return candidate_groups(s1, blocks, guard_empty)
