"""The shape of the plans at scale, with broadcasts out of the picture."""

import pytest

from pyspark.sql import functions as F

from kindred import session
from kindred.operators import blocks, evaluate, keys, labels, lists, pairs, quality
from kindred.plans import catalog
from kindred.plans.catalog import QUERIES
from kindred.sources import tables
from kindred.sources.tables import line_records, sources

from conftest import rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame):
    return plan_of(frame).count("Exchange hashpartitioning")


@pytest.fixture
def linked(records):
    s1 = records([("S1-1", "us", "acme foo", "1 main")])
    others = records([("S2-1", "us", "acme foo", "1 main", "s2")])
    return s1, others


def test_no_join_without_keys_and_no_global_window(linked, no_broadcast, spark):
    s1, others = linked
    groups = blocks.candidates(s1, others)
    truth = spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, entity_id string")
    labelled = labels.label_pairs(blocks.explode_groups(groups), truth)
    scored = pairs.rule_score(pairs.pair_features(labelled, s1, others))
    counts = labels.counts_of(truth)
    frames = [
        groups,
        keys.all_keys(s1, others),
        lists.result_lists(pairs.accepted(scored, 0.5), s1),
        evaluate.blocking_metrics(s1, labelled, counts),
        evaluate.blocking_summary(s1, others, groups),
        evaluate.threshold_sweep(scored),
        evaluate.macro_f05(s1, scored, counts),
    ]
    for frame in frames:
        plan = plan_of(frame)
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        # A single partition is only ever the end of a whole-table aggregate.
        assert plan.count("SinglePartition") <= 1


def test_pairs_are_moved_once(linked, no_broadcast):
    """Keys, blocks, S1 keys, lists by S1 id, S1 records, pairs, other records."""
    s1, others = linked
    assert exchanges(blocks.candidates(s1, others)) == 4
    assert exchanges(pairs.group_features(blocks.candidates(s1, others), s1, others)) == 7


def test_lists_need_no_further_exchange_of_candidates(linked, no_broadcast):
    s1, others = linked
    groups = blocks.candidates(s1, others)
    assert exchanges(lists.candidate_lists(groups, s1)) == 5


def test_labelled_pairs_are_moved_once(linked, no_broadcast):
    """As for features without labels: the keys travel with the records."""
    s1, others = linked
    rows = pairs.group_features(blocks.candidates(s1, others), s1, others, key=F.col("name"))
    assert exchanges(rows) == 7


def test_scan_reads_what_it_needs(spark):
    records = line_records(spark, SF_DIR)
    plan = plan_of(records.all())
    assert plan.count("FileScan") == 1 and "n_chars" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in plan_of(
        records.s1.select("entity_id")
    )


@pytest.mark.parametrize(
    "name",
    ["match_targets", "normalize_basic", "keys_all", "block_sizes", "blocks", "candidate_lists",
     "blocking_metrics", "feature_totals", "threshold_sweep", "macro_f05", "result_lists", "dq_report",
     "predict_summary", "label_counts"],
)
def test_tables_are_read_at_most_twice(spark, name, monkeypatch):
    """Scans of a benchmark table in the plans of a query, staged tables included."""
    scans = []
    staged = session.stage

    def counted(df, *args, **kwargs):
        scans.append(df)
        return staged(df, *args, **kwargs)

    for module in (session, tables, catalog, quality):
        monkeypatch.setattr(module, "stage", counted)
    scans.append(QUERIES[name](spark, SF_DIR))
    assert sum(plan_of(df).count("sf0.001/") for df in scans) <= 2


def test_records_need_no_python_worker(spark):
    for normalizer in ("basic", "rich"):
        plan = plan_of(sources(spark, SF_DIR, "documents", normalizer=normalizer).all())
        assert "Python" not in plan and "Arrow" not in plan


def test_report_cuts_examples_before_its_exchange(spark):
    found = spark.createDataFrame([("extra_row", "S1-1")], "rule string, offender string")
    plan = plan_of(quality.report(found))
    assert plan.count("WindowGroupLimit") == 2


def test_invariants_on_the_lines(spark):
    """Matches are candidates, blocks keep their cap, and every S1 record has one row."""
    inputs = sources(spark, SF_DIR, "documents")
    built = blocks.build_blocks(inputs.others, cap=20)
    assert built.filter("size(s2_ids) > 20 OR size(s3_ids) > 20").count() == 0
    groups = blocks.candidate_groups(inputs.s1, built)
    scored = pairs.rule_score(pairs.group_features(groups, inputs.s1, inputs.others))
    matches = lists.result_lists(pairs.accepted(scored, 0.4), inputs.s1)
    assert rows_of(matches.select("source1_entity_id")) == rows_of(inputs.s1.select("entity_id"))
    own = lists.candidate_lists(groups, inputs.s1)
    rows, candidate_rows = (quality.parse_lines(quality.as_lines(x)) for x in (matches, own))
    assert quality.subset_findings(rows, candidate_rows).count() == 0
