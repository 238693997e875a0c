import pytest

from kindred.operators import blocks, evaluate, labels, lists

from conftest import rows_of


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, probability double")


def test_sweep_against_counting(spark):
    rows = [(1, 0.95), (1, 0.72), (0, 0.72), (0, 0.5), (1, 0.49), (0, 0.1), (1, 0.7)]
    for r in evaluate.threshold_sweep(scored(spark, rows)).collect():
        tp = sum(l == 1 and p >= r.threshold for l, p in rows)
        fp = sum(l == 0 and p >= r.threshold for l, p in rows)
        fn = sum(l == 1 and p < r.threshold for l, p in rows)
        assert (r.true_positives, r.predicted_pairs) == (tp, tp + fp)
        assert r.precision == (tp / (tp + fp) if tp + fp else 0.0)
        assert r.recall == tp / (tp + fn)
        assert r.f05 == pytest.approx(1.25 * tp / (1.25 * tp + fp + 0.25 * fn) if tp else 0.0)


def test_best_threshold(spark):
    rows = [(1, 0.95), (1, 0.72), (0, 0.6), (0, 0.5)]
    best = evaluate.best_threshold(evaluate.threshold_sweep(scored(spark, rows))).first()
    # Perfect from 0.65 to 0.70: the lowest wins.
    assert best == (0.65, 1.0)


@pytest.mark.parametrize("rows", [[], [(0, 0.9)], [(1, 0.1)]])
def test_best_threshold_without_hits(spark, rows):
    best = evaluate.best_threshold(evaluate.threshold_sweep(scored(spark, rows))).first()
    assert best == (0.5, 0.0)


def test_macro_counts_lost_and_empty(spark):
    s1 = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "entity_id string")
    matches = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 1), ("b", "y", 0)],
        "source1_entity_id string, candidate_entity_id string, label int",
    )
    truth = spark.createDataFrame([("a", "x"), ("c", "z")], "source1_entity_id string, entity_id string")
    truth = labels.counts_of(truth)
    got = rows_of(evaluate.entity_f05(s1, matches, truth))
    assert got == [("a", 1, 0, 0, 1.0), ("b", 0, 1, 0, 0.0), ("c", 0, 0, 1, 0.0), ("d", 0, 0, 0, 1.0)]
    assert evaluate.macro_f05(s1, matches, truth).first() == (4, 0.5)


@pytest.fixture
def blocked(spark):
    s1 = spark.createDataFrame([("a",), ("b",), ("c",)], "entity_id string")
    groups = spark.createDataFrame(
        [("a", ["S2-2", "S2-1"], ["S3-1"]), ("b", ["S2-1"], [])],
        "source1_entity_id string, s2_ids array<string>, s3_ids array<string>",
    )
    truth = spark.createDataFrame(
        [("a", "S2-1"), ("a", "S3-9"), ("b", "S2-1"), ("c", "S2-5")],
        "source1_entity_id string, entity_id string",
    )
    pairs = blocks.explode_groups(groups)
    return s1, groups, labels.label_pairs(pairs, truth), labels.counts_of(truth)


def test_blocking_metrics(blocked):
    s1, groups, labelled, counts = blocked
    got = evaluate.blocking_metrics(s1, labelled, counts).first().asDict()
    assert got == {
        "true_pairs": 4, "found_pairs": 2, "entities_with_truth": 3, "entities_any_found": 2,
        "entities_all_found": 1, "candidate_pairs": 4, "avg_candidates": 4 / 3, "max_candidates": 3,
        "zero_candidate_s1": 1,
    }
    assert evaluate.pair_recall(labelled, counts).first() == (4, 2, 0.5)
    assert rows_of(evaluate.candidates_per_s1(s1, groups)) == [("a", 3), ("b", 1), ("c", 0)]
    assert rows_of(evaluate.zero_candidate_s1(s1, groups)) == [("c",)]


def test_no_truth_gives_zeros(blocked):
    s1, _, labelled, counts = blocked
    got = evaluate.blocking_metrics(s1, labelled, counts.limit(0)).first()
    assert (got.true_pairs, got.found_pairs, got.entities_with_truth) == (0, 0, 0)
    assert evaluate.pair_recall(labelled, counts.limit(0)).first() == (0, 0, 0.0)


def test_entities_without_candidates_count_zero_without_ansi(blocked, conf):
    conf("spark.sql.ansi.enabled", "false")
    s1, groups, labelled, counts = blocked
    assert rows_of(evaluate.candidates_per_s1(s1, groups)) == [("a", 3), ("b", 1), ("c", 0)]
    assert evaluate.blocking_metrics(s1, labelled, counts).first().candidate_pairs == 4


def test_lists(spark, blocked):
    s1, groups, *_ = blocked
    assert rows_of(lists.candidate_lists(groups, s1)) == [("a", "S2-1,S2-2,S3-1"), ("b", "S2-1"), ("c", "")]
    assert rows_of(lists.candidate_lists(groups, s1, per_source=True)) == [
        ("a", "S2-1,S2-2", "S3-1"), ("b", "S2-1", ""), ("c", "", "")]
    matches = spark.createDataFrame(
        [("a", "S3-1"), ("a", "S2-1"), ("a", "S2-1")], "source1_entity_id string, candidate_entity_id string"
    )
    assert rows_of(lists.result_lists(matches, s1)) == [("a", "S2-1,S3-1"), ("b", ""), ("c", "")]
