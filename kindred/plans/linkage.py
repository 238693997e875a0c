"""The whole linkage as a chain of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.functions.text import normalize_records
from kindred.operators import blocks, labels, lists, pairs
from kindred.operators.model import Matcher, score_pairs, train
from kindred.operators.paging import number_rows
from kindred.session import stage
from kindred.sources import files


def labelled_features(
    s1: DataFrame, others: DataFrame, truth: DataFrame, **blocking
) -> DataFrame:
    """Training rows: candidates labelled by the lists of ``truth``, with their features."""
    groups = labels.with_truth(blocks.candidates(s1, others, **blocking), truth)
    return pairs.group_features(groups, s1, others)


def link_files_by_rule(
    spark: SparkSession,
    s1_path: str,
    s2_path: str,
    s3_path: str,
    matches_path: str,
    candidates_path: str,
    threshold: float,
) -> None:
    """Source files to a file of match lists and one of candidate lists, by the rule score.

    The candidate lists are the bulk of what is written; they are compressed.
    """
    s1, others = load_sources(spark, s1_path, s2_path, s3_path)
    numbered = number_rows(s1.select("entity_id"))
    own = lists.candidate_lists(blocks.candidates(s1, others), numbered)
    _write_lists(own, numbered, candidates_path, compression="gzip")
    scored = pairs.rule_score(pairs.block_features(s1, others))
    matches = lists.result_lists(pairs.accepted(scored, threshold), numbered)
    _write_lists(matches, numbered, matches_path)


def _write_lists(rows: DataFrame, numbered: DataFrame, path: str, **options) -> None:
    """The listing of lists of the ``numbered`` S1 rows."""
    numbers = numbered.withColumnRenamed("entity_id", "source1_entity_id")
    files.write_numbered(rows, numbers, path, "source1_entity_id", **options)


def link_by_rule(s1: DataFrame, others: DataFrame, threshold: float, **blocking) -> DataFrame:
    """Match lists from the fixed rule score; needs no model."""
    scored = pairs.rule_score(pairs.block_features(s1, others, blocking=blocking))
    return lists.result_lists(pairs.accepted(scored, threshold), s1)


def train_from_files(
    spark: SparkSession, s1_path: str, s2_path: str, s3_path: str, truth_path: str, **options
) -> tuple[Matcher, DataFrame]:
    """Read training files, fit a matcher, return it with the threshold sweep.

    Normalised records and features are written to the shared folder: both are read
    several times, and the model reads the features once per round.
    """
    s1, others = load_sources(spark, s1_path, s2_path, s3_path)
    truth = labels.restrict_truth(files.read_truth(spark, truth_path), s1)
    rows = labelled_features(s1, others, truth)
    return train(stage(labels.with_split(rows).hint("rebalance"), "features", "split"), **options)


def load_sources(
    spark: SparkSession, s1_path: str, s2_path: str, s3_path: str, normalizer: str = "basic"
) -> tuple[DataFrame, DataFrame]:
    """Normalised and staged S1, and S2 with S3 tagged by source."""
    s1, s2, s3 = (
        normalize_records(files.read_records(spark, p), normalizer)
        for p in (s1_path, s2_path, s3_path)
    )
    return stage(s1, "s1"), stage(pairs.candidate_records(s2, s3), "others")


def predict_to_files(
    spark: SparkSession,
    matcher: Matcher,
    s1_path: str,
    s2_path: str,
    s3_path: str,
    matches_path: str,
    candidates_path: str | None = None,
) -> DataFrame:
    """Score the candidates of the given files and write one row per S1 entity.

    Candidate groups are staged: they are the input of two outputs, and the bulk of the
    work lies before them. Returns the scored pairs.
    """
    s1, others = load_sources(spark, s1_path, s2_path, s3_path)
    groups = stage(blocks.candidates(s1, others), "candidates")
    numbered = number_rows(s1.select("entity_id"))
    if candidates_path:
        _write_lists(lists.candidate_lists(groups, numbered), numbered, candidates_path)
    scored = score_pairs(matcher, pairs.group_features(groups, s1, others))
    kept = scored.select("source1_entity_id", "candidate_entity_id", "probability")
    matches = pairs.accepted(kept, matcher.threshold)
    _write_lists(lists.result_lists(matches, numbered), numbered, matches_path)
    return scored
