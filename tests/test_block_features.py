"""Features of records that meet at their blocks, against those of exploded groups."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from kindred.operators import blocks, pairs

RECORDS = "entity_id string, name string, address string, country string, source string"
WORDS = ["alpha", "beta", "gamma", "delta", "omega"]


def records(spark):
    rows = []
    for i in range(60):
        name = f"{WORDS[i % 5]} {WORDS[i % 3]} shop{i % 7}"
        address = f"{i % 4} {WORDS[i % 2]} road{i % 9}"
        for source in ("s1", "s2", "s3"):
            rows.append((f"{source}-{i}", name, address, "de" if i % 6 else "fr", source))
    rows += rows[::4]  # repeated rows
    rows += [("s1-1", "beta other", "9 lane", "de", "s1"), ("s2-2", "alpha shop3", None, "de", "s2")]
    rows += [("both", "alpha beta shop1", "1 beta road1", "de", s) for s in ("s2", "s3")]
    rows += [(None, "alpha beta shop1", "", "de", s) for s in ("s1", "s2", "s3")]
    rows += [("s1-x", None, "", "", "s1"), ("s3-x", "", None, None, "s3")]
    return spark.createDataFrame(rows, RECORDS)


@pytest.mark.parametrize("options, guard", [({}, True), ({"cap": 3, "low": 1, "guard_empty": False}, False)])
def test_pairs_are_those_of_the_groups_each_once(spark, options, guard):
    found = records(spark)
    s1, others = found.filter("source = 's1'"), found.filter("source <> 's1'")
    key = F.concat_ws("|", "country", "name")
    groups = pairs.group_features(blocks.candidates(s1, others, **options), s1, others, guard, key)
    met = pairs.block_features(s1, others, guard, key, options)
    assert met.columns == groups.columns
    expected = Counter(map(tuple, groups.collect()))
    assert expected and Counter(map(tuple, met.collect())) == expected


def test_no_pair_is_moved(spark):
    found = records(spark)
    features = pairs.block_features(found.filter("source = 's1'"), found.filter("source <> 's1'"))
    plan = features._jdf.queryExecution().sparkPlan().toString().splitlines()
    compared = next(i for i, line in enumerate(plan) if "arrays_overlap" in line)
    assert not [line for line in plan[:compared] if "Join" in line or "Exchange" in line]


def test_addresses_do_not_travel(spark, monkeypatch):
    """A digest stands for the address of a record at its blocks."""
    seen, at_blocks = {}, pairs._at_blocks
    monkeypatch.setattr(pairs, "_at_blocks", lambda rows, side: seen.update({side: rows}) or at_blocks(rows, side))
    found = records(spark)
    pairs.block_features(found.filter("source = 's1'"), found.filter("source <> 's1'"))
    kinds = [seen[side].schema[f"{side}address"].dataType.simpleString() for side in ("left_", "right_")]
    assert kinds == ["binary", "binary"]


def test_addresses_within_each_other(spark):
    long = " ".join(f"word{i}" for i in range(300))
    addresses = [
        "a b c d", "b c", "x a b c d y", "xa b c dy", "a  b", " a b", "a b ", "", None, "c", "b", "a c", "b c d e", "é b c",
        "éé b cc", long, long[1:], long[:-1], long[3:-4], long.replace("word150", "word15"), long + " a b c d", "word1 word3",
    ]
    rows = [(f"{s}-{i}", "acme", a, "de", s) for s in ("s1", "s2", "s3") for i, a in enumerate(addresses)]
    found = spark.createDataFrame(rows, RECORDS)
    s1, others = found.filter("source = 's1'"), found.filter("source <> 's1'")
    expected = Counter(map(tuple, pairs.group_features(blocks.candidates(s1, others), s1, others).collect()))
    met = pairs.block_features(s1, others)
    assert len(expected) == 2 * len(addresses) ** 2 and Counter(map(tuple, met.collect())) == expected
    assert met.filter("address_contains > address_exact").count() > 40


def test_a_record_brings_along_what_it_meets(spark, monkeypatch):
    """Many S1 records with the same short address: each has the longer ones of its own blocks."""
    rows = [(f"s1-{i}", f"name{i}", "main", "de", "s1") for i in range(30)]
    rows += [(f"s2-{i}", f"name{i}", f"{i} main road{i}", "de", "s2") for i in range(30)]
    found = spark.createDataFrame(rows, RECORDS)
    near, met_addresses = [], pairs._met_addresses
    monkeypatch.setattr(pairs, "_met_addresses", lambda *sides: near.append(met_addresses(*sides)) or near[0])
    met = pairs.block_features(found.filter("source = 's1'"), found.filter("source <> 's1'"), blocking={"high": 20})
    assert met.filter("address_contains = 1").count() == met.count() == 30
    assert [len(row["left_near"]) for row in near[0].collect()] == [1] * 30
