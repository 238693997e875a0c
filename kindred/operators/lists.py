"""Per-entity lists: candidates and final matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _s1_ids(s1: DataFrame) -> DataFrame:
    """The ids, and the numbers of the rows if they have them."""
    return s1.select(F.col("entity_id").alias("source1_entity_id"), *_numbers(s1))


def _numbers(s1: DataFrame) -> list[str]:
    return [c for c in ("row_number",) if c in s1.columns]


def _sorted_list(ids: Column) -> Column:
    return F.coalesce(F.array_join(F.sort_array(F.array_distinct(ids)), ","), F.lit(""))


def candidate_lists(groups: DataFrame, s1: DataFrame, per_source: bool = False) -> DataFrame:
    """One row per S1 entity with its sorted candidates, empty if it has none.

    ``per_source`` gives a column for each source instead of one for both. A ``row_number``
    that ``s1`` has stays, last.
    """
    rows = _s1_ids(s1).join(groups, "source1_entity_id", "left")
    if per_source:
        return rows.select(
            "source1_entity_id",
            _sorted_list(F.col("s2_ids")).alias("candidate_s2_ids"),
            _sorted_list(F.col("s3_ids")).alias("candidate_s3_ids"),
            *_numbers(s1),
        )
    both = _sorted_list(F.concat("s2_ids", "s3_ids"))
    return rows.select("source1_entity_id", both.alias("candidate_entity_ids"), *_numbers(s1))


def result_lists(matches: DataFrame, s1: DataFrame) -> DataFrame:
    """One row per S1 entity with its sorted distinct matches, empty if it has none. A
    ``row_number`` that ``s1`` has stays, last."""
    lists = matches.groupBy("source1_entity_id").agg(
        F.collect_set("candidate_entity_id").alias("ids")
    )
    return (
        _s1_ids(s1)
        .join(lists, "source1_entity_id", "left")
        .select("source1_entity_id", _sorted_list(F.col("ids")).alias("matched_entity_ids"), *_numbers(s1))
    )
