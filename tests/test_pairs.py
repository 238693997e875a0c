import pytest
from pyspark.sql import functions as F

from kindred.operators import labels, pairs
from kindred.schemas import FEATURES

from conftest import rows_of


def features(spark, records, left, right, guard=True):
    """Features of one pair of ``(country, name, address)`` records, by name."""
    s1 = records([("S1-1", *left)])
    others = records([("S2-1", *right, "s2")])
    pair = spark.createDataFrame(
        [("S1-1", "S2-1", "s2", 1)],
        "source1_entity_id string, candidate_entity_id string, source string, label int",
    )
    row = pairs.pair_features(pair, s1, others, guard).first().asDict()
    assert list(row) == ["source1_entity_id", "candidate_entity_id", "source", "label", *FEATURES]
    return {f: row[f] for f in FEATURES}


def test_equal_records(spark, records):
    got = features(spark, records, ("us", "big acme ltd", "12 main st"), ("us", "big acme ltd", "12 main st"))
    ones = {f for f, v in got.items() if v == 1}
    assert ones == set(FEATURES) - {"name_length_diff", "address_length_diff", "name_missing", "address_missing"}


def test_partial_match(spark, records):
    got = features(spark, records, ("us", "acme ltd", "12 main"), ("de", "acme ltd germany", "rd 12"))
    assert got["country_match"] == 0 and got["name_exact"] == 0
    assert got["name_first_match"] == 1 and got["name_last_match"] == 0 and got["name_first_two_match"] == 1
    assert got["name_contains"] == 1 and got["name_length_diff"] == 8 and got["name_length_ratio"] == 0.5
    assert got["address_first_match"] == 0 and got["address_number_match"] == 1 and got["address_contains"] == 0


def test_one_word_names_guarded_and_not(spark, records):
    left, right = ("us", "acme", ""), ("us", "beta", "")
    assert features(spark, records, left, right)["name_first_two_match"] == 0
    assert features(spark, records, left, right)["address_first_match"] == 0
    loose = features(spark, records, left, right, guard=False)
    assert loose["name_first_two_match"] == 1 and loose["address_first_match"] == 1
    assert loose["address_number_match"] == 0 and loose["address_exact"] == 0


@pytest.mark.parametrize(
    "left, right, missing, diff, ratio",
    [
        (None, "abcde", 0, None, 1.0),
        (None, None, 0, None, None),
        ("", "abcde", 1, 5, 0.0),
        ("", "", 1, 0, 0.0),
        ("", None, 1, None, 0.0),
    ],
)
def test_missing_names(spark, records, left, right, missing, diff, ratio):
    got = features(spark, records, ("us", left, "x"), ("us", right, "x"))
    assert (got["name_missing"], got["name_length_diff"], got["name_length_ratio"]) == (missing, diff, ratio)
    loose = features(spark, records, ("us", left, "x"), ("us", right, "x"), guard=False)
    assert loose["name_first_two_match"] == (1 if left == "" and right == "" else 0) or right == "abcde"


def test_null_never_equals_null(spark, records):
    got = features(spark, records, ("us", None, None), ("us", None, None), guard=False)
    assert got["name_first_match"] == got["name_first_two_match"] == got["address_first_match"] == 0


def test_group_and_pair_features_agree(spark, records):
    s1 = records([("S1-1", "us", "acme", "1 a"), ("S1-2", "us", "foo", None)])
    others = records([("S2-1", "us", "acme", "1 a", "s2"), ("S3-1", "us", "foo bar", "x", "s3")])
    groups = spark.createDataFrame(
        [("S1-1", ["S2-1"], ["S3-1"]), ("S1-2", [], ["S3-1"])],
        "source1_entity_id string, s2_ids array<string>, s3_ids array<string>",
    )
    truth = spark.createDataFrame(
        [("S1-1", "S2-1"), ("S1-1", "S2-9")], "source1_entity_id string, entity_id string"
    )
    by_group = pairs.group_features(groups, s1, others)
    labelled = labels.label_pairs(pairs.explode_groups(groups), truth)
    by_pair = pairs.pair_features(labelled, s1, others)
    assert by_pair.count() == 3 and by_pair.agg(F.sum("label")).first()[0] == 1
    got = sorted(map(str, by_group.collect()))
    assert got == sorted(map(str, by_pair.drop("label").collect()))


def test_truth(spark):
    truth = spark.createDataFrame(
        [("S1-1", "S2-1, S3-2"), ("S1-2", "S2-1,"), ("S1-3", ""), ("S1-4", None), ("S1-9", "S2-7")],
        "source1_entity_id string, matched_entity_ids string",
    )
    s1 = spark.createDataFrame([(f"S1-{i}",) for i in range(1, 5)], "entity_id string")
    known = labels.restrict_truth(truth, s1)
    assert rows_of(labels.true_pairs(known)) == [("S1-1", "S2-1"), ("S1-1", "S3-2"), ("S1-2", ""), ("S1-2", "S2-1")]


def test_split_keeps_entities_whole(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("S1-"), "id").alias("source1_entity_id"))
    split = labels.with_split(ids.union(ids))
    sides = split.groupBy("source1_entity_id").agg(F.countDistinct("split").alias("n"))
    assert sides.filter("n <> 1").count() == 0
    share = split.filter("split = 'validation'").count() / split.count()
    assert abs(share - 0.2) < 0.02
