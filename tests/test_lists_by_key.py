"""Truth lists made per copy key, and the subset rule by sizes and digests of lists."""

from conftest import rows_of
from pyspark.sql import functions as F

from kindred.operators import quality
from kindred.sources import tables


def test_lists_are_not_moved_once_they_are_written_out(spark, records, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(f"S{1 + i % 3}-{i}", "us", f"n{i % 4}", "a", f"s{1 + i % 3}") for i in range(60)]
    rows += [("S1-0", "us", "n1", "b", "s1"), ("S1-0", "us", None, "b", "s1"), (None, "us", "n2", "c", "s1")]
    rows += [("S2-1", "us", "n1", "twice", "s2"), ("S3-none", None, None, None, "s3"), ("S1-alone", "fr", "", "", "s1")]
    inputs = tables.Sources(records(rows))
    found = tables.truth_lists(inputs, "pages")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(copy_key" in plan[: plan.index("Exchange hashpartitioning(source1_entity_id")]
    key = {}
    for i, country, name, _, source in rows:
        key.setdefault(i if source == "s1" else None, []).append((country or "", name or ""))
    expected = []
    for i in key.keys() | {None}:
        own = [(c or "", n or "") for e, c, n, _, s in rows if s == "s1" and e == i]
        copies = sorted(e for k in own for e, c, n, _, s in rows if s != "s1" and (c or "", n or "") == k)
        if own:
            expected.append((i, ",".join(copies)))
    assert sorted(rows_of_nullable(found)) == sorted((str(a), b) for a, b in expected)
    assert len(expected) == len({i for i, *_, s in rows if s == "s1"})


def rows_of_nullable(frame):
    return [(str(r[0]), r[1]) for r in frame.collect()]


def test_subset_rule_compares_ids_only_where_sizes_and_digests_leave_it_open(spark, monkeypatch):
    schema = "source1_entity_id string, ids array<string>"
    rows = spark.createDataFrame([
        ("equal", ["a", "b", "a", "b"]), ("longer", ["a", "b", "c"]), ("inside", ["b"]), ("outside", ["x"]),
        ("order", ["b", "a"]), ("no candidates", ["a"]), ("empty", []), ("blank", [""]), (None, ["a"]),
        ("two rows", ["a"]), ("two rows", ["z"]), ("two lists", ["a", "c"]),
    ], schema)
    candidates = spark.createDataFrame([
        ("equal", ["a", "b"]), ("longer", ["a", "b"]), ("inside", ["a", "b"]), ("outside", ["a", "b"]),
        ("order", ["a", "b"]), ("empty", ["a"]), ("blank", []), (None, ["a"]), ("two rows", ["a", "b"]),
        ("two lists", ["a", "b"]), ("two lists", ["c"]), ("unused", ["a"]),
    ], schema)
    staged = []

    def held(frame, name):
        staged.append(rows_of(frame.fillna("null").fillna({"outside": False}).select("source1_entity_id", F.col("outside"))))
        return frame

    monkeypatch.setattr(quality, "stage", held)
    found = quality.subset_findings(rows, candidates).collect()
    offenders = sorted(str(r.offender) for r in found)
    assert offenders == ["None", "blank", "longer", "no candidates", "outside", "two rows"]
    judged = dict(staged[0])
    assert not {"equal", "empty"} & judged.keys() and judged["longer"] and judged["no candidates"]
    assert [x for x, outside in staged[0] if not outside] == ["inside", "order", "outside", "two lists", "two rows"]


def test_a_broken_header_of_several_files_is_one_finding(spark, records, tmp_path):
    path = str(tmp_path / "commas")
    lists = spark.createDataFrame([(f"S1-{i}", "S2-1") for i in range(8)], "source1_entity_id string, matched_entity_ids string")
    lists.repartition(4).write.option("header", "true").csv(path)
    required = records([(f"S1-{i}", "us", "a", "b") for i in range(8)])
    found = quality.check_files(spark, path, required).filter("rule = 'comma_header'").collect()
    assert [(r.rule, r.n) for r in found] == [("comma_header", 1)]
