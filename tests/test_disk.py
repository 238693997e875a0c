"""What queries leave on disk and move on the way."""

import os
import time
from collections import Counter

from pyspark.sql import functions as F

from kindred.operators import blocks, labels, lists, pairs, quality
from kindred.operators.paging import number_rows
from kindred.plans import catalog
from kindred.session import stage
from kindred.sources import files, tables

from conftest import rows_of

LISTS = "source1_entity_id string, matched_entity_ids string"


def shuffle_files(spark):
    """Shuffle files that the session has now."""
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for top in held for _, _, names in os.walk(str(top)) for name in names if name.startswith("shuffle_")}


def left_behind(spark, work):
    """Shuffle files made by ``work`` that stay; Spark removes them in the background."""
    before = shuffle_files(spark)
    work()
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    held = []
    assert not left_behind(spark, lambda: held.append(stage(rows, "counts")))
    assert held[0].count() == 7
    assert not left_behind(spark, lambda: files.write_tsv(rows, str(tmp_path / "tsv")))
    lists_ = rows.select(F.concat(F.lit("S1-"), "k").alias("source1_entity_id"), F.lit("S2-1").alias("matched_entity_ids"))
    numbers = number_rows(lists_.select("source1_entity_id"), "source1_entity_id")
    numbered = lists_.join(numbers, "source1_entity_id")
    assert not left_behind(spark, lambda: files.write_numbered(numbered, numbers, str(tmp_path / "n"), "source1_entity_id"))


def test_candidate_ids_are_not_taken_apart_to_be_moved(spark, records, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    s1 = records([("S1-1", "us", "acme foo", "1 main"), ("S1-1", "us", "acme bar", ""), ("S1-2", "us", "none such", "")])
    others = records([(f"S{s}-{i}", "us", name, "1 main", f"s{s}") for s in (2, 3) for i, name in enumerate(["acme foo", "acme bar"])])
    groups = blocks.candidates(s1, others)
    plan = groups._jdf.queryExecution().executedPlan().toString()
    joined = plan[: plan.index("SortMergeJoin")]
    assert "Generate" not in joined and joined.count("Exchange") == 1
    assert rows_of(lists.candidate_lists(groups, s1)) == [
        ("S1-1", "S2-0,S2-1,S3-0,S3-1"), ("S1-1", "S2-0,S2-1,S3-0,S3-1"), ("S1-2", ""),
    ]


def test_numbered_lists_are_moved_once_and_lie_in_order(spark, tmp_path, conf, monkeypatch):
    """Folders of 128 rows in parts of 50: in name order they are one sorted listing."""
    monkeypatch.setattr(files, "ROWS_PER_PART", 50)
    rows = [(f"S1-{i % 900:03}" if i % 90 else None, "" if i % 2 else f"S2-{i % 900}") for i in range(990)]
    unique = spark.createDataFrame(sorted({(i, m) for i, m in rows if i}), LISTS)
    s1 = unique.select(F.col("source1_entity_id").alias("entity_id")).unionByName(
        spark.createDataFrame([(None,), ("S1-001",), ("S1-001",)], "entity_id string")
    )
    matches = unique.filter("matched_entity_ids <> ''").withColumnRenamed("matched_entity_ids", "candidate_entity_id")

    def written(name):
        numbered = number_rows(s1)
        own = lists.result_lists(matches, numbered)
        plan = own._jdf.queryExecution().executedPlan().toString()
        assert own.columns[-1] == "row_number" and "rangepartitioning" not in plan
        numbers = numbered.withColumnRenamed("entity_id", "source1_entity_id")
        files.write_numbered(own, numbers, str(tmp_path / name), "source1_entity_id", 128, "gzip")
        folders = sorted((tmp_path / name).glob("file=*"))
        read = [spark.read.options(header="false").text(str(p)) for f in folders for p in sorted(f.glob("part-*"))]
        return [[r.value for r in part.collect()] for part in read]

    first = written("a")
    conf("spark.sql.shuffle.partitions", "7")
    assert written("b") == first
    body = [line for part in first for line in part[1:]]
    found = {r[0]: r[1] for r in unique.collect()}
    expected = [i.entity_id for i in s1.orderBy("entity_id").collect()]
    assert body == [f"{i or ''}\t{found.get(i, '')}" for i in expected]
    sizes = [r.rows for r in files.read_manifest(spark, str(tmp_path / "a")).orderBy("file").collect()]
    assert sum(sizes) == len(expected) and set(sizes[:-1]) == {128}
    assert max(len(part) for part in first) == 51 and len(first) > 2 * len(sizes)


def test_listing_in_parts_is_that_in_one(spark, tmp_path, monkeypatch):
    rows = [(f"S1-{i % 90:03}", f"S2-{i}") for i in range(200)]
    table = spark.createDataFrame(rows, LISTS)
    monkeypatch.setattr(files, "ROWS_PER_PART", 30)
    files.write_listing(table, str(tmp_path / "c"), "source1_entity_id", 100)
    parts = [p for f in sorted((tmp_path / "c").glob("file=*")) for p in sorted(f.glob("part-*"))]
    assert len(parts) == 8
    assert [x for p in parts for x in p.read_text().splitlines()[1:]] == sorted("\t".join(r) for r in rows)


def test_blocks_without_an_s1_record_are_not_compared(spark, records, monkeypatch):
    """Records are dealt out only to blocks where they meet one, once the rest is written."""
    staged, stage_ = {}, pairs.stage
    monkeypatch.setattr(pairs, "stage", lambda df, name: staged.setdefault(name, stage_(df, name)))
    s1 = records([("S1-1", "us", "acme foo", "1 main road", "s1")])
    others = records([(f"S2-{i}", "us", "acme foo", f"other words{i // 2} for{i // 2} main", "s2") for i in range(6)])
    met = pairs.block_features(s1, others)
    groups = pairs.group_features(blocks.candidates(s1, others), s1, others)
    assert rows_of(met) == rows_of(groups) and len(rows_of(met)) == 6
    used = {b for r in staged["left"].select("blocks").collect() for b in r.blocks}
    assert {b for r in staged["right"].select("blocks").collect() for b in r.blocks} <= used
    assert "near" in staged


def test_headers_and_bodies_are_read_where_lines_lie(spark, tmp_path, conf):
    """No task sorts the lines of a file for its header, and none are moved to leave it out."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for i, text in enumerate(["a\tb\n\nx\t1\n", "c\td", "", "\n \nlast\n"]):
        (tmp_path / f"{i}.tsv").write_text(text)
    lines = files.read_file_lines(spark, str(tmp_path))
    headers = files.headers_of(lines)
    body = files.body_of(lines, headers)
    for frame in (headers, body):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "file#" not in x]
        assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert sorted(r.header for r in headers.collect()) == ["", "a\tb", "c\td"]
    assert rows_of(body) == [("last",), ("x\t1",)]


def test_lists_are_dealt_out_also_if_they_are_few(spark, records, conf):
    """Chunks of a key are dealt anew after they meet their list, whose size Spark did not know."""
    conf("spark.sql.autoBroadcastJoinThreshold", "32m")
    rows = [(f"S{1 + i % 3}-{i}", "us", f"n{i % 4}", "a", f"s{1 + i % 3}") for i in range(60)]
    inputs = tables.Sources(records(rows))
    found = tables.truth_lists(inputs, "pages")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan[: plan.index("Initial Plan")]


def test_sorted_lines_are_cut_into_ranges_by_their_beginnings(spark, tmp_path, conf):
    """Lines may be long, and Spark holds a sample of what ranges are cut by."""
    conf("spark.sql.shuffle.partitions", "5")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    texts = [f"S1-{i % 70:03}\t" + "x" * (i % 3 * 200) + f",é{i}" for i in range(300)] + ["é", "z", "", "S1-0", "S1-001"]
    files.write_lines(spark.createDataFrame([(t,) for t in texts], "value string").repartition(3), str(tmp_path / "lines"))
    parts = sorted((tmp_path / "lines").glob("part-*"))
    read = [r.value for p in parts for r in spark.read.text(str(p)).collect()]
    assert read == sorted(texts) and 1 < len(parts) <= 5


def test_malformed_lines_do_not_cut_ranges_by_whole_lines(spark, records, monkeypatch):
    frame = type(spark.range(0))
    ranged, by = [], frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, *c: ranged.append(str(c)) or by(self, *c))
    catalog.QUERIES["dq_malformed_lines"](spark, "/root/testdata/sf0.001")
    assert ranged and all("substring" in c for c in ranged)


def test_subset_rule_compares_no_ids_where_ends_decide(spark, monkeypatch):
    """An id before the first or after the last candidate is none; without others nothing is compared."""
    schema = "source1_entity_id string, ids array<string>"
    rows = [("after", ["x"]), ("before", ["A", "b"]), ("equal", ["b", "c"]), ("twice", ["a"]), ("twice", ["z"]), ("none", [])]
    candidates = [(i, ["b", "c", "d"] if i != "equal" else ["b", "c"]) for i in ("after", "before", "equal", "twice", "none")]
    rows, candidates = (spark.createDataFrame(x, schema) for x in (rows, candidates))
    compared, listed_ids = [], quality.listed_ids
    monkeypatch.setattr(quality, "listed_ids", lambda r: compared.append(r) or listed_ids(r))
    assert rows_of(quality.subset_findings(rows, candidates).select("offender")) == [("after",), ("before",), ("twice",)]
    assert not compared
    inside = spark.createDataFrame([("in", ["c"]), ("out", ["c2"]), ("part", ["b", None])], schema)
    others = spark.createDataFrame([(i, ["b", "c", "d"]) for i in ("in", "out", "part")], schema)
    assert rows_of(quality.subset_findings(inside, others).select("offender")) == [("out",), ("part",)]
    assert len(compared) == 2


def test_pairs_of_a_large_key_are_made_in_tiles(spark, records, conf, monkeypatch):
    """Each pair once, whichever tiles its records are in, and no task makes all pairs of the key."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(labels, "TILE", 10)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(f"S1-{i}", "us", "hot", "", "s1") for i in range(64)] + [(f"S2-{i}", "us", "hot", "", "s2") for i in range(33)]
    rows += [("S1-twice", "us", "hot", "", "s1")] * 2 + [(None, "us", "hot", "", s) for s in ("s1", "s2")]
    rows += [("S1-few", "us", "few", "", "s1"), ("S3-few", "us", "few", "", "s3"), ("S3-none", "us", None, "", "s3")]
    rows += [(f"S1-alone{i}", "us", "alone", "", "s1") for i in range(12)] + [("S1-none", "us", None, "", "s1")]
    inputs = tables.Sources(records(rows))
    found = labels.true_pairs_by_key(inputs.s1, inputs.others, F.col("name"))
    expected = [(a, b) for a, _, k, _, s in rows if s == "s1" for b, _, j, _, t in rows if t != "s1" and k and k == j]
    assert found.columns == ["source1_entity_id", "entity_id"]
    assert Counter(map(tuple, found.collect())) == Counter(expected)
    made = [r.n for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(made) > 1 and max(made) < 0.9 * len(expected)
