import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kindred.operators import blocks, keys, pairs

from conftest import rows_of


def keys_of(frame):
    return {(r.key_type, r.block_key) for r in frame.collect()}


def test_one_word_name(records):
    got = keys_of(keys.basic_keys(records([("a", "us", "acme", None)])))
    assert got == {(1, "us|acme"), (2, "us|acme|acme")}


def test_three_word_name(records):
    got = keys_of(keys.basic_keys(records([("a", "us", "big acme ltd", "")])))
    assert got == {(1, "us|big acme ltd"), (2, "us|big|ltd"), (3, "us|big|acme")}


@pytest.mark.parametrize(
    "address, guarded, loose",
    [
        ("12b main", "us|12|b", "us|12|b"),
        ("main st 12", "us|12|main", "us|12|main"),
        ("12", None, "us|12|"),
        ("12 main", "us|12|main", "us|12|main"),
        ("main", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_address_key(records, address, guarded, loose):
    frame = records([("a", "us", None, address)])
    for guard, expected in ((True, guarded), (False, loose)):
        assert keys_of(keys.basic_keys(frame, guard)) == ({(4, expected)} if expected is not None else set())


def test_no_keys_without_country(records):
    frame = records([("a", "", "acme", "12 main"), ("b", None, "acme", "12 main")])
    assert keys_of(keys.record_keys(frame)) == set()
    loose = keys.record_keys(frame.filter("entity_id = 'a'"), guard_empty=False)
    assert keys_of(loose) == {(5, "|acme"), (6, "|main")}


def test_index_words(records):
    frame = records([("a", "us", "ab abc 123 12c abc ١٢٣", None)])
    got = sorted(r.block_key for r in keys.record_keys(frame, distinct_words=False).filter("key_type = 5").collect())
    assert got == ["us|12c", "us|abc", "us|abc", "us|١٢٣"]


def test_rare_word_counts_uses(records):
    frame = records(
        [("b1", "us", "buffalo buffalo", None, "s2"), ("b2", "us", "lonely", None, "s2"),
         ("b3", "us", "shared", None, "s2"), ("c1", "us", "shared", None, "s3"),
         ("c2", "de", "shared", None, "s3")]
    )
    assert rows_of(keys.rare_words(frame, "name")) == [("us", "buffalo"), ("us", "shared")]
    built = blocks.build_blocks(frame).filter("key_type = 5")
    got = {(r.block_key, tuple(sorted(r.s2_ids)), tuple(sorted(r.s3_ids))) for r in built.collect()}
    assert got == {("us|buffalo", ("b1",), ()), ("us|shared", ("b3",), ("c1",))}


def test_cap_is_per_source_and_uses_are_pooled(records):
    rows = [(f"b{i:03}", "us", "same name", None, "s2") for i in range(101)]
    rows += [(f"c{i:03}", "us", "same name", None, "s3") for i in range(100)]
    built = {(r.key_type, len(r.s2_ids), len(r.s3_ids)) for r in blocks.build_blocks(records(rows)).collect()}
    # The S2 block is one over the cap; the S3 block is kept; the words have 201 uses.
    assert built == {(1, 0, 100), (2, 0, 100), (3, 0, 100)}


def test_duplicate_rows_count_once(records):
    rows = [("b1", "us", "same name", None, "s2")] * 300 + [("b2", "us", "same name", None, "s2")]
    built = blocks.build_blocks(records(rows), cap=2, high=2).filter("key_type = 1").collect()
    assert [sorted(r.s2_ids) for r in built] == [["b1", "b2"]]


def brute_force(s1, others, cap, low, high):
    """Candidates by nested loops over the keys of every record."""

    def fixed(country, name, address):
        found = set()
        if country and name:
            w = name.split(" ")
            found |= {(1, country, name), (2, country, w[0], w[-1])}
            if len(w) > 1:
                found.add((3, country, w[0], w[1]))
        return found

    def words(country, name, address):
        for kind, field in ((5, name), (6, address)):
            for w in (field or "").split(" "):
                if len(w) >= 3 and not w.isdigit():
                    yield kind, country, w

    uses = defaultdict(int)
    for _, *fields, _ in others:
        for w in words(*fields):
            uses[w] += 1
    members = defaultdict(set)
    for entity, *fields, source in others:
        for k in fixed(*fields) | {w for w in words(*fields) if low <= uses[w] <= high}:
            members[k, source].add(entity)
    pairs = set()
    for entity, *fields in s1:
        for k in fixed(*fields) | set(words(*fields)):
            for source in ("s2", "s3"):
                if len(members[k, source]) <= cap:
                    pairs |= {(entity, other, source) for other in members[k, source]}
    return pairs


@pytest.mark.parametrize("seed, cap, high", [(1, 100, 100), (2, 3, 100), (3, 3, 5), (4, 10, 4)])
def test_candidates_equal_brute_force(records, seed, cap, high):
    rng = random.Random(seed)
    vocabulary = ["acme", "foo", "ltd", "bar", "baz", "tech", "one", "two", "ab", "12", "345", "corp"]

    def text():
        return " ".join(rng.choices(vocabulary, weights=range(1, 13), k=rng.randint(1, 4)))

    def record(prefix, i):
        return (f"{prefix}{i:03}", rng.choice(["us", "de"]), rng.choice([text(), "", None]), text())

    s1 = [record("a", i) for i in range(60)]
    others = [(*record("b", i), "s2") for i in range(60)] + [(*record("c", i), "s3") for i in range(60)]
    # Addresses here hold numbers: key 4 is left to the oracle queries.
    s1 = [(*r[:3], (r[3] or "").replace("12", "no").replace("345", "non")) for r in s1]
    others = [(*r[:3], (r[3] or "").replace("12", "no").replace("345", "non"), r[4]) for r in others]
    groups = blocks.candidates(records(s1), records(others), cap=cap, high=high)
    got = rows_of(blocks.explode_groups(groups))
    assert len(got) == len(set(got))
    assert set(got) == brute_force(s1, others, cap, 2, high)


def test_more_candidates_with_a_higher_cap(records):
    s1 = records([("a1", "us", "same name", "x")])
    others = records([(f"b{i}", "us", "same name" if i < 8 else "same other", "y", "s2") for i in range(12)])
    sizes = [blocks.explode_groups(blocks.candidates(s1, others, cap=c)).count() for c in (4, 8, 100)]
    assert sizes == sorted(sizes) and sizes[0] < sizes[-1]


def test_staged_and_fused_keys_agree(records):
    """The table of keys an operator at a time gives the blocks of the fused plan."""
    rng = random.Random(9)
    rows = [
        (f"{s}{i}", "us", " ".join(rng.choices(["acme", "foo", "bar", "ltd"], k=3)), f"{i % 3} main", s)
        for s in ("s2", "s3") for i in range(30)
    ]
    frame = records(rows)
    staged = rows_of(blocks.block_sizes(keys.all_keys(frame, frame), cap=8))
    fused = rows_of(
        blocks.by_source(blocks.build_blocks(frame, cap=8), "key_type", "block_key").select(
            "key_type", "block_key", "source", F.size("entity_ids").cast("bigint")
        )
    )
    assert staged == fused


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_blocks_are_cut_before_the_exchange(records):
    """The only exchange of a block build lies above a partial cut by rank."""
    frame = records([("b1", "us", "acme foo", "1 main", "s2")])
    plan = plan_of(blocks.build_blocks(frame))
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_hot_s1_key_is_split(spark, conf):
    """A third of S1 shares one name: adaptive execution splits it, and no row is lost."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "0")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    n = 30_000
    hot = F.col("id") % 3 == 0
    s1 = spark.range(0, n, 1, 16).select(
        F.concat(F.lit("S1-"), "id").alias("entity_id"),
        F.lit("us").alias("country"),
        F.when(hot, "hot name").otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("name"),
        F.md5(F.col("id").cast("string")).alias("address"),
    )
    others = spark.range(0, 3, 1, 3).select(
        F.concat(F.lit("S2-"), "id").alias("entity_id"),
        F.lit("us").alias("country"),
        F.lit("hot name").alias("name"),
        F.lit("x").alias("address"),
        F.lit("s2").alias("source"),
    )
    groups = blocks.candidates(s1.withColumn("address", F.lit("x")), others)
    rows = groups.agg(F.count("*").alias("n"), F.sum(F.size("s2_ids")).alias("pairs"))
    assert rows.collect() == [(n // 3, n)]
    assert "skew=true) [key_type" in plan_of(rows).split("== Initial Plan ==")[0]

    rare = keys.rare_words(others, "name")
    found = keys.rare_keys(s1, rare, keys.NAME_WORD).groupBy("block_key").count()
    assert rows_of(found) == [("us|hot", n // 3), ("us|name", n // 3)]
    assert "skew=true" in plan_of(found).split("== Initial Plan ==")[0]

    # Each of the 3 records now meets a third of S1: that join is split too.
    features = pairs.group_features(groups, s1, others)
    total = features.agg(F.count("*").alias("n"), F.sum("address_contains").alias("same"))
    assert total.collect() == [(n, 0)]
    assert "skew=true) [candidate_entity_id" in plan_of(total).split("== Initial Plan ==")[0]
