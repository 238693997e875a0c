"""Counts of labelled candidates per S1 entity without a pair."""

import random

from conftest import rows_of
from pyspark.sql import functions as F

from kindred.operators import blocks, evaluate, labels


def _records(rng, source, n):
    """Few words, so that blocks overflow; some ids, and some missing, have several records."""
    words = [f"word{i}" for i in range(12)]
    rows = []
    for i in range(n):
        entity = None if i % 17 == 0 else f"{source.upper()}-{i - i % 2 if i % 11 == 0 else i}"
        name = rng.choice([None, "", " ".join(rng.choices(words, k=2))])
        rows.append((entity, rng.choice(["us", "fr", None]), name, rng.choice(["12 main", " ".join(rng.choices(words, k=3))]), source))
    return rows + rows[:9]


def test_counts_are_those_of_the_labelled_pairs(spark, records):
    rng = random.Random(5)
    s1 = records(_records(rng, "s1", 60))
    s2 = _records(rng, "s2", 70)
    # The same id in both sources stands for two candidates.
    others = records(s2 + _records(rng, "s3", 60) + [(e, c, n, a, "s3") for e, c, n, a, _ in s2[:20]])
    key = F.concat_ws("|", F.coalesce("country", F.lit("")), F.coalesce("name", F.lit("")))
    counts = labels.true_counts(s1, others, key)
    for cap in (100, 3):
        pairs = labels.label_by_key(blocks.candidates(s1, others, cap=cap), s1, others, key)
        met = labels.met_by_key(s1, others, key, cap=cap)
        expected = pairs.groupBy("source1_entity_id").agg(F.count("*").alias("n"), F.sum(F.col("label").cast("bigint")).alias("m"))
        assert rows_of(met) == rows_of(expected) and met.filter("n_found > 0").count() > 5
        found = labels.met_by_key(s1, others, key, cap=cap, count_all=False)
        assert rows_of(found) == rows_of(expected.filter("m > 0").drop("n"))
        for figures in (labels.label_counts,):
            assert rows_of(figures(met)) == rows_of(figures(pairs))
        for counted in (met, found):
            assert rows_of(evaluate.pair_recall(counted, counts)) == rows_of(evaluate.pair_recall(pairs, counts))
        assert rows_of(evaluate.blocking_metrics(s1, met, counts)) == rows_of(evaluate.blocking_metrics(s1, pairs, counts))
    nothing = labels.label_counts(labels.met_by_key(s1.limit(0), others.limit(0), key))
    assert rows_of(nothing) == [(0, 0, 0)]


def test_recall_makes_no_other_pairs(spark, records, conf):
    """Records that share a block but no key are not brought together for recall."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    s1 = records([("S1-1", "us", "acme foo", "1 main", "s1")])
    others = records([("S2-1", "us", "acme foo", "1 main", "s2"), ("S2-2", "us", "acme foo", "2 side", "s2")])
    found = labels.met_by_key(s1, others, F.concat("name", "address"), count_all=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "[key_type#" in plan and all("left_key" in line for line in plan.splitlines() if "Join [key_type" in line)
    assert rows_of(found) == [("S1-1", 1)]


def _most_rows(plan):
    """The most rows that any join of an executed plan has put out."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _most_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _most_rows(plan.plan())
    if kind == "ReusedExchangeExec":
        return 0
    own = plan.metrics().apply("numOutputRows").value() if "Join" in kind else 0
    children = plan.children()
    return max([own, *(_most_rows(children.apply(i)) for i in range(children.size()))])


def test_copies_do_not_multiply(spark, records):
    """Forty copies on each side are 1,600 pairs, of which none is made."""
    rows = [(f"{s}-{i}", "us", "acme foo", "12 main road", s.lower()) for s in ("S1", "S2") for i in range(40)]
    s1, others = records(rows[:40]), records(rows[40:])
    found = labels.met_by_key(s1, others, F.concat("name", "address"), count_all=False)
    assert rows_of(found) == sorted((f"S1-{i}", 40) for i in range(40))
    found.collect()
    assert 40 <= _most_rows(found._jdf.queryExecution().executedPlan()) < 1600
