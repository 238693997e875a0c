"""Blocking recall, thresholds and F0.5."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The thresholds tried, and the one used when none scores.
THRESHOLDS = [0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.92, 0.94, 0.96, 0.98]
DEFAULT_THRESHOLD = 0.5


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def f_half(tp: Column, fp: Column, fn: Column) -> Column:
    """F-beta for beta = 0.5 from counts; 0 when there is nothing to count."""
    weighted = F.lit(1.25) * tp
    return _ratio(weighted, weighted + fp + F.lit(0.25) * fn)


# --- blocking ---------------------------------------------------------------


def candidates_per_s1(s1: DataFrame, groups: DataFrame) -> DataFrame:
    """``(source1_entity_id, n_candidates)`` for every S1 entity, zero included."""
    # array_size of NULL is NULL in any mode; size of NULL may be -1.
    size = F.coalesce(F.array_size("s2_ids") + F.array_size("s3_ids"), F.lit(0)).cast("bigint")
    ids = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    return ids.join(groups, "source1_entity_id", "left").select(
        "source1_entity_id", size.alias("n_candidates")
    )


def zero_candidate_s1(s1: DataFrame, groups: DataFrame) -> DataFrame:
    """S1 entities without a candidate."""
    ids = s1.select(F.col("entity_id").alias("source1_entity_id"))
    return ids.join(groups, "source1_entity_id", "left_anti")


def _met(labelled: DataFrame) -> DataFrame:
    """Candidates and true ones among them of each S1 entity; ``labels.met_by_key`` has them."""
    if "n_found" in labelled.columns:
        return labelled
    return labelled.groupBy("source1_entity_id").agg(
        F.count("*").alias("n_candidates"), F.sum(F.col("label").cast("bigint")).alias("n_found")
    )


def truth_per_s1(labelled: DataFrame, counts: DataFrame) -> DataFrame:
    """``(source1_entity_id, n_true, n_found)`` for entities with a true pair.

    ``labelled`` has the candidates, or their counts, ``counts`` the true pairs of each entity.
    Both meet as one row per entity.
    """
    found = _met(labelled).select("source1_entity_id", "n_found")
    return counts.join(found, "source1_entity_id", "left").select(
        "source1_entity_id", "n_true", F.coalesce("n_found", F.lit(0)).alias("n_found")
    )


def pair_recall(labelled: DataFrame, counts: DataFrame) -> DataFrame:
    """True pairs, those found by blocking, and their share."""
    return (
        truth_per_s1(labelled, counts)
        .agg(
            F.coalesce(F.sum("n_true"), F.lit(0)).alias("true_pairs"),
            F.coalesce(F.sum("n_found"), F.lit(0)).alias("found_pairs"),
        )
        .withColumn("pair_recall", _ratio(F.col("found_pairs").cast("double"), F.col("true_pairs")))
    )


def blocking_metrics(s1: DataFrame, labelled: DataFrame, counts: DataFrame) -> DataFrame:
    """All blocking figures in one row, from one pass over the labelled candidates."""
    met = _met(labelled)
    ids = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    per_s1 = (
        ids.join(met, "source1_entity_id", "left")
        .join(counts, "source1_entity_id", "left")
        .select(
            F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
            "n_true",
            F.when(F.col("n_true").isNotNull(), F.coalesce("n_found", F.lit(0))).alias("n_found"),
        )
    )
    n_true, n_found = F.col("n_true"), F.col("n_found")

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))

    return per_s1.agg(
        total(n_true).alias("true_pairs"),
        total(n_found).alias("found_pairs"),
        F.count(n_true).alias("entities_with_truth"),
        F.count_if(n_found > 0).alias("entities_any_found"),
        F.count_if(n_found == n_true).alias("entities_all_found"),
        total("n_candidates").alias("candidate_pairs"),
        F.avg("n_candidates").alias("avg_candidates"),
        F.max("n_candidates").alias("max_candidates"),
        F.count_if(F.col("n_candidates") == 0).alias("zero_candidate_s1"),
    )


def blocking_summary(s1: DataFrame, others: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows per source and candidate figures in one row."""
    counted = candidates_per_s1(s1, groups).select(F.lit("s1").alias("source"), "n_candidates")
    rows = counted.unionByName(others.select("source"), allowMissingColumns=True)

    def of(tag):
        return F.count_if(F.col("source") == tag).alias(f"{tag}_rows")

    return rows.agg(
        of("s1"),
        of("s2"),
        of("s3"),
        F.sum("n_candidates").alias("candidate_pairs"),
        F.avg("n_candidates").alias("avg_candidates"),
        F.count_if(F.col("n_candidates") == 0).alias("zero_candidate_s1"),
    )


# --- thresholds -------------------------------------------------------------


def threshold_sweep(scored: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """Precision, recall and F0.5 over pairs at each threshold.

    A pair counts at every threshold up to its score. Pairs are first counted by how
    many thresholds they reach, so one small aggregate answers for all of them.
    """
    ordered = sorted(thresholds)
    reached = reduce(
        lambda a, b: a + b, [(F.col("probability") >= t).cast("int") for t in ordered]
    )
    counts = scored.groupBy(reached.alias("reached")).agg(
        F.count("*").alias("n"), F.sum(F.col("label").cast("bigint")).alias("positive")
    )

    def at(i):
        passed = F.col("reached") > i
        return F.struct(
            F.lit(ordered[i]).alias("threshold"),
            F.coalesce(F.sum(F.when(passed, F.col("positive"))), F.lit(0)).alias("tp"),
            F.coalesce(F.sum(F.when(passed, F.col("n"))), F.lit(0)).alias("predicted"),
        )

    swept = counts.agg(
        F.array(*[at(i) for i in range(len(ordered))]).alias("rows"),
        F.coalesce(F.sum("positive"), F.lit(0)).alias("positives"),
    ).select(F.explode("rows").alias("r"), "positives")
    tp, predicted = F.col("r.tp"), F.col("r.predicted")
    return swept.select(
        F.col("r.threshold").alias("threshold"),
        predicted.alias("predicted_pairs"),
        tp.alias("true_positives"),
        _ratio(tp.cast("double"), predicted).alias("precision"),
        _ratio(tp.cast("double"), F.col("positives")).alias("recall"),
        f_half(tp, predicted - tp, F.col("positives") - tp).alias("f05"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The lowest threshold with the highest F0.5; the default if all are zero."""
    score = F.when(F.col("f05") > 0, F.struct(F.col("f05"), -F.col("threshold")))
    best = F.max_by("threshold", score)
    return sweep.agg(
        F.coalesce(best, F.lit(DEFAULT_THRESHOLD)).alias("best_threshold"),
        F.coalesce(F.max("f05"), F.lit(0.0)).alias("best_f05"),
    )


def entity_f05(s1: DataFrame, matches: DataFrame, counts: DataFrame) -> DataFrame:
    """True and false positives, misses and F0.5 of every S1 entity.

    ``matches`` are accepted pairs with their ``label``. True pairs lost in blocking count
    as misses. An entity with no truth and no match scores 1.
    """
    label = F.col("label").cast("bigint")
    per_entity = (
        matches.select("source1_entity_id", "candidate_entity_id", label.alias("label")).distinct()
        .groupBy("source1_entity_id").agg(F.sum("label").alias("tp"), F.sum(1 - F.col("label")).alias("fp"))
    )
    ids = s1.select(F.col("entity_id").alias("source1_entity_id"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    score = F.when(tp + fp + fn == 0, F.lit(1.0)).otherwise(f_half(tp, fp, fn))
    return (
        ids.join(per_entity, "source1_entity_id", "left")
        .join(counts, "source1_entity_id", "left")
        .select(
            "source1_entity_id",
            F.coalesce("tp", F.lit(0)).alias("tp"),
            F.coalesce("fp", F.lit(0)).alias("fp"),
            (F.coalesce("n_true", F.lit(0)) - F.coalesce("tp", F.lit(0))).alias("fn"),
        )
        .withColumn("f05", score)
    )


def macro_f05(s1: DataFrame, matches: DataFrame, counts: DataFrame) -> DataFrame:
    """F0.5 averaged over S1 entities."""
    return entity_f05(s1, matches, counts).agg(
        F.count("*").alias("entities"), F.avg("f05").alias("macro_f05")
    )


def predict_summary(s1: DataFrame, scored: DataFrame, threshold) -> DataFrame:
    """S1 rows, pairs, accepted pairs and entities with a match in one row.

    Accepted pairs are counted per entity first; the total is then one row per entity.
    """
    hit = F.count_if(F.col("probability") >= threshold)
    per_entity = scored.groupBy("source1_entity_id").agg(
        F.count("*").alias("pairs"), hit.alias("accepted")
    )
    ids = s1.select(F.col("entity_id").alias("source1_entity_id"))
    return ids.join(per_entity, "source1_entity_id", "left").agg(
        F.count("*").alias("s1_rows"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("candidate_pairs"),
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("predicted_pairs"),
        F.count_if(F.col("accepted") > 0).alias("s1_with_match"),
        F.lit(threshold).alias("threshold"),
    )
