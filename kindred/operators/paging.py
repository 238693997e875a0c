"""Row numbers in id order, and the pages they make."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import use_checkpoints


def number_rows(ids: DataFrame, column: str = "entity_id") -> DataFrame:
    """``ids`` with ``row_number``, 1-based in the order of ``column``.

    A window without partitions would sort everything in one task. Here rows are
    range-partitioned and sorted where they are; a row's number is its place in its
    partition plus the sizes of the partitions before. The sorted rows are checkpointed
    in the shared folder, so both uses see the same partitions.
    """
    use_checkpoints(ids.sparkSession)
    # Ids given by Spark hold the partition in the upper bits, the place in the lower 33.
    placed = (
        ids.repartitionByRange(column)
        .sortWithinPartitions(column)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id") - F.shiftleft(F.col("_part"), 33))
        .checkpoint()
    )
    # One row per partition: few enough to be summed up in one task and broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *ids.columns, (F.col("_offset") + F.col("_place") + 1).alias("row_number")
    )


def rows_between(ids: DataFrame, first: int, last: int, column: str = "entity_id") -> DataFrame:
    """Rows number ``first`` to ``last`` in the order of ``column``, both included."""
    return number_rows(ids, column).filter(F.col("row_number").between(first, last))


def pages(ids: DataFrame, size: int = 100_000) -> DataFrame:
    """``(page, entity_id)``: ids in order, ``size`` to a page, pages from 0."""
    page = F.floor((F.col("row_number") - 1) / F.lit(size)).cast("bigint")
    return number_rows(ids.select("entity_id")).select(page.alias("page"), "entity_id")


def first_rows(records: DataFrame, n: int) -> DataFrame:
    """The ``n`` records with the lowest ids."""
    return records.orderBy("entity_id").limit(n)
