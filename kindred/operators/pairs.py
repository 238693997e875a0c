"""Pair features from pairs or candidate groups and the normalised records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.features import feature_columns, record_parts
from kindred.operators.blocks import build_blocks, by_source, explode_groups
from kindred.operators.keys import record_keys
from kindred.schemas import PAIR_KEYS
from kindred.session import stage

_LEFT, _RIGHT = "left_", "right_"


def candidate_records(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """Records of S2 and S3 in one table, tagged by source."""
    return s2.withColumn("source", F.lit("s2")).unionByName(s3.withColumn("source", F.lit("s3")))


def _s1_side(s1: DataFrame, key: Column | None = None) -> DataFrame:
    keyed = [] if key is None else [key.alias(f"{_LEFT}key")]
    return s1.select(F.col("entity_id").alias("source1_entity_id"), *record_parts(_LEFT), *keyed)


def _other_side(others: DataFrame, key: Column | None = None) -> DataFrame:
    keyed = [] if key is None else [key.alias(f"{_RIGHT}key")]
    return others.select(
        F.col("entity_id").alias("candidate_entity_id"), "source", *record_parts(_RIGHT), *keyed
    )


def _compared(
    met: DataFrame, guard_empty: bool, extra: list, key: Column | None = None, address_contains: str | None = None
) -> DataFrame:
    """Features of pairs that hold the parts of both records; with ``key`` also their label."""
    if key is not None:
        same = F.coalesce(F.col(f"{_LEFT}key") == F.col(f"{_RIGHT}key"), F.lit(False))
        extra = [*extra, same.cast("int").alias("label")]
    return met.select(*PAIR_KEYS, *extra, *feature_columns(_LEFT, _RIGHT, guard_empty, address_contains))


def _compare(
    pairs: DataFrame, others: DataFrame, guard_empty: bool, key: Column | None = None
) -> DataFrame:
    """Features of ``pairs`` that already hold the parts of their S1 record."""
    extra = [c for c in pairs.columns if c not in PAIR_KEYS and not c.startswith(_LEFT)]
    met = pairs.join(_other_side(others, key), ["candidate_entity_id", "source"])
    return _compared(met, guard_empty, extra, key)


def pair_features(
    pairs: DataFrame, s1: DataFrame, others: DataFrame, guard_empty: bool = True
) -> DataFrame:
    """The sixteen features of any table of pairs; further columns such as ``label`` stay."""
    return _compare(pairs.join(_s1_side(s1), "source1_entity_id"), others, guard_empty)


def group_features(
    groups: DataFrame,
    s1: DataFrame,
    others: DataFrame,
    guard_empty: bool = True,
    key: Column | None = None,
) -> DataFrame:
    """The same from candidate groups. Parts of the S1 records are joined before the
    groups are exploded, so the pairs are moved once, to meet their candidate records.
    With ``key`` there is also a ``label``, 1 where both records have the same key; groups
    with ``true_ids`` are labelled by these: the true and the other ids of a group are two
    groups, so that no list is searched per pair."""
    if "true_ids" in groups.columns:
        lists = ("s2_ids", "s3_ids")
        sides = F.array(
            *[
                F.struct(*[pick(i, "true_ids").alias(i) for i in lists], F.lit(label).alias("label"))
                for label, pick in ((1, F.array_intersect), (0, F.array_except))
            ]
        )
        kept = [c for c in groups.columns if c not in (*lists, "true_ids")]
        groups = groups.select(*kept, F.explode(sides).alias("side")).select(*kept, "side.*")
    return _compare(explode_groups(groups.join(_s1_side(s1, key), "source1_entity_id")), others, guard_empty, key)


def _digest(text: Column) -> Column:
    return F.when(text == "", F.lit(b"")).otherwise(F.unhex(F.md5(text)))


def _word_bits(words: str, half: int) -> Column:
    """One of 128 bits for every word, in two halves: a word whose bit is not set is not among them."""
    bit = f"if(pmod(hash(word), 128) DIV 64 = {half}, shiftleft(1L, pmod(hash(word), 64)), 0L)"
    return F.expr(f"aggregate({words}, 0L, (bits, word) -> bits | {bit})")


def _signed(rows: DataFrame, side: str) -> DataFrame:
    """``rows`` with the digest of their address in its place, and the bits of its words and of
    those between its first and last. Copies lie beside each other, so that they compress."""
    address, words = f"{side}address", f"split({side}address, ' ')"
    inner = f"slice({words}, 2, greatest(size({words}) - 2, 0))"
    bits = {f"{side}bits{i}": _word_bits(words, i) for i in (0, 1)}
    bits |= {f"{side}inner{i}": _word_bits(inner, i) for i in (0, 1)}
    signed = rows.withColumns(bits | {address: _digest(F.col(address))})
    copies = f"{side}name", address
    return signed.hint("rebalance", *copies).sortWithinPartitions(*copies)


def _met_addresses(left: DataFrame, right: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """``(left_row, left_near)``: for an S1 record the digests of the different addresses that it meets
    at a block and that contain its own or are contained in it. They belong to records, not to
    addresses, so that none has more than it meets however many have the same address.

    The longer must have all words of the shorter but its first and last. Only where the bits of the
    words leave that open are the texts themselves compared.
    """

    def at(rows, side, *more):
        kept = [f"{side}{c}" for c in ("address", "address_length", "bits0", "bits1", "inner0", "inner1")]
        return rows.filter(F.col(kept[0]) != F.lit(b"")).select(*kept, *more, F.explode("blocks").alias("block"))

    def within(a, b):
        words = " AND ".join(f"{a}inner{i} & ~{b}bits{i} = 0" for i in (0, 1))
        return f"{a}address_length < {b}address_length AND {words}"

    met = at(left, _LEFT, "left_row").hint("merge").join(at(right, _RIGHT), "block")
    met = met.filter(f"({within(_LEFT, _RIGHT)}) OR ({within(_RIGHT, _LEFT)})")
    longer = F.col("left_address_length") > F.col("right_address_length")
    met = met.select(
        "left_row",
        F.when(longer, F.col("left_address")).otherwise(F.col("right_address")).alias("long"),
        F.when(longer, F.col("right_address")).otherwise(F.col("left_address")).alias("short"),
        longer.alias("left_long"),
    )
    texts = s1.select("address").unionByName(others.select("address")).filter("address <> ''").distinct()

    def text_of(name):
        return texts.select(_digest(F.col("address")).alias(name), F.col("address").alias(f"{name}_text"))

    near = met.join(text_of("short"), "short").join(text_of("long"), "long").filter("contains(long_text, short_text)")
    return near.groupBy("left_row").agg(F.collect_set(F.expr("if(left_long, short, long)")).alias("left_near"))


def _at_blocks(rows: DataFrame, side: str) -> DataFrame:
    """Each record at every one of its ``blocks``, with those before it."""
    signs = [f"{side}{sign}{i}" for sign in ("bits", "inner") for i in (0, 1)]
    kept = [c for c in rows.columns if c not in ("blocks", *signs)]
    each = rows.select(*kept, "blocks", F.posexplode("blocks").alias("at", "block"))
    return each.select(*kept, "block", F.slice("blocks", F.lit(1), F.col("at")).alias(f"{side}before"))


def _numbered(built: DataFrame) -> DataFrame:
    """``built`` with the numbers in ``block`` made dense, and integers where they fit: a row carries
    many of them."""
    part, row = F.shiftright("block", 33), F.col("block").bitwiseAND(F.lit((1 << 33) - 1))
    most = built.agg(F.max(part).alias("part"), F.max(row).alias("row")).first()
    width = (most["row"] or 0) + 1
    kind = "int" if ((most["part"] or 0) + 1) * width < 1 << 31 else "bigint"
    return built.withColumn("block", (part * width + row).cast(kind))


def block_features(
    s1: DataFrame,
    others: DataFrame,
    guard_empty: bool = True,
    key: Column | None = None,
    blocking: dict | None = None,
) -> DataFrame:
    """``group_features`` of all candidates of ``s1`` (``blocks.candidates`` with the options
    ``blocking``) without moving a pair: the records of both sides meet at their blocks, and are
    compared there.

    What is moved grows with the records and their keys, not with the pairs. Two records with
    several blocks in common are compared at the first of them: each brings along the blocks
    before the one it is at, and no other pair of theirs has none in common. Blocks belong to
    ids, so repeated records of an id all meet where the id does. A key that very many S1
    records share is split by adaptive execution, as both sides come straight from their exchange.

    Addresses are long and do not travel: a digest stands for them, and an S1 record brings along
    the digests of those it meets that contain its address or are contained in it. Rows at blocks are merge
    joined, as the sizes Spark knows are those before they are dealt out to their blocks.
    """
    options = blocking or {}
    built = _numbered(
        stage(build_blocks(others, **options).withColumn("block", F.monotonically_increasing_id()), "blocks")
    )
    keys = record_keys(s1, guard_empty=options.get("guard_empty", True))
    met = keys.join(built.select("key_type", "block_key", "block"), ["key_type", "block_key"])
    wanted = met.groupBy(F.col("entity_id").alias("source1_entity_id")).agg(F.collect_set("block").alias("blocks"))
    left = wanted.withColumn("blocks", F.sort_array("blocks")).join(_s1_side(s1, key), "source1_entity_id")
    left = stage(_signed(left, _LEFT).withColumn("left_row", F.monotonically_increasing_id()), "left")
    # At a block without an S1 record nothing is compared.
    used = built.join(left.select(F.explode("blocks").alias("block")).distinct(), "block", "left_semi")
    members = by_source(used, "block").select(
        F.explode("entity_ids").alias("candidate_entity_id"), "source", "block"
    )
    owned = members.groupBy("candidate_entity_id", "source").agg(F.collect_list("block").alias("blocks"))
    right = owned.withColumn("blocks", F.sort_array("blocks")).join(
        _other_side(others, key), ["candidate_entity_id", "source"]
    )
    right = stage(_signed(right, _RIGHT), "right")
    # Written, so that its shuffles are gone before the records are dealt out to their blocks.
    near = stage(_met_addresses(left, right, s1, others), "near")
    left = left.join(near, "left_row", "left").drop("left_row")
    pairs = _at_blocks(left, _LEFT).hint("merge").join(_at_blocks(right, _RIGHT), "block")
    first = ~F.arrays_overlap(f"{_LEFT}before", f"{_RIGHT}before")
    return _compared(pairs.filter(first), guard_empty, [], key, "array_contains(left_near, right_address)")


# Weights of the stand-in score, in the order they are added.
SCORE_WEIGHTS = {
    "country_match": 0.0625,
    "name_exact": 0.25,
    "name_first_match": 0.0625,
    "name_last_match": 0.0625,
    "name_first_two_match": 0.125,
    "name_contains": 0.0625,
    "name_length_ratio": 0.0625,
    "address_exact": 0.125,
    "address_first_match": 0.03125,
    "address_number_match": 0.03125,
    "address_contains": 0.0625,
    "address_length_ratio": 0.0625,
}


def rule_score(features: DataFrame) -> DataFrame:
    """``features`` with a fixed weighted sum in ``probability``, for use without a model."""
    terms = [f"{w}D * coalesce(CAST({f} AS DOUBLE), 0.0D)" for f, w in SCORE_WEIGHTS.items()]
    return features.withColumn("probability", F.expr(" + ".join(["0.0D", *terms])))


def accepted(scored: DataFrame, threshold) -> DataFrame:
    """Pairs at or above the threshold."""
    return scored.filter(F.col("probability") >= threshold)
