import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import blocks, labels, paging, pairs, quality
from kindred.schemas import MATCH_HEADER
from kindred.sources import files, tables

from conftest import rows_of
from test_plans import plan_of


@pytest.fixture
def write(tmp_path):
    def to(name, text):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return to


def test_tsv_is_read_as_it_is(spark, write):
    path = write("s.tsv", "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
                          "S1-1\t\"Acme\" \\Co\t\t US \nS1-2\t'x\ty\"\tDE\n")  # fmt: skip
    assert files.read_records(spark, path).orderBy("entity_id").collect() == [
        ("S1-1", '"Acme" \\Co', None, " US "), ("S1-2", "'x", 'y"', "DE")]


def test_columns_are_found_by_name(spark, write):
    path = write("s.tsv", "country\tentity_id\tnote\tbusiness_address\tbusiness_name\r\nUS\tS1-1\tx\t1 main\tAcme\r\n")
    assert files.read_records(spark, path).collect() == [("S1-1", "Acme", "1 main", "US")]


def test_results_are_written_sorted_with_empty_lists(spark, tmp_path):
    table = spark.createDataFrame([(f"S1-{i:03}", "" if i % 2 else "S2-1,S3-1") for i in range(200)],
                                  "source1_entity_id string, matched_entity_ids string")
    path = tmp_path / "out"
    files.write_tsv(table, str(path), "source1_entity_id")
    lines = [part.read_text().splitlines() for part in sorted(path.glob("part-*"))]
    assert all(p[0] == "\t".join(MATCH_HEADER) for p in lines)
    body = [line for p in lines for line in p[1:]]
    assert body == [f"S1-{i:03}\t" + ("" if i % 2 else "S2-1,S3-1") for i in range(200)]
    assert rows_of(files.read_truth(spark, str(path)).fillna("")) == rows_of(table)


def test_listings_have_the_same_bytes_in_any_run(spark, tmp_path, conf):
    rows = [(f"S1-{i % 900:03}", "" if i % 2 else f"S2-{i}") for i in range(1000)]
    schema = "source1_entity_id string, matched_entity_ids string"

    def written(name, table):
        files.write_listing(table, str(tmp_path / name), "source1_entity_id", rows_per_file=128)
        parts = sorted((tmp_path / name).glob("file=*/part-*"))
        assert len({p.parent for p in parts}) == len(parts) == 8
        return [p.read_bytes() for p in parts]

    first = written("a", spark.createDataFrame(rows, schema))
    conf("spark.sql.shuffle.partitions", "11")
    assert written("b", spark.createDataFrame(rows[::-1], schema).repartition(5)) == first
    body = [line for part in first for line in part.decode().splitlines()[1:]]
    assert body == sorted("\t".join(r) for r in rows)
    listed = files.read_manifest(spark, str(tmp_path / "a")).orderBy("file").collect()
    assert [r.rows for r in listed] == [128] * 7 + [104]
    assert [(r.first, r.last) for r in listed] == [
        (p.decode().splitlines()[1].split("\t")[0], p.decode().splitlines()[-1].split("\t")[0]) for p in first
    ]
    assert rows_of(files.read_truth(spark, str(tmp_path / "a")).fillna("")) == sorted(rows)
    assert quality.parse_lines(files.read_lines(spark, str(tmp_path / "b"))).count() == 1000
    files.write_listing(spark.createDataFrame([], schema), str(tmp_path / "none"), "source1_entity_id")
    assert files.read_manifest(spark, str(tmp_path / "none")).count() == 0


def test_id_scan_skips_blank_lines(spark, write):
    path = write("s.tsv", "entity_id\tname\n S2-1 \tx\n\n  \t \nS2-2\nS2-1\ty\n")
    assert rows_of(files.read_ids(spark, path)) == [("S2-1",), ("S2-2",)]


def test_headers_of_split_files(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "64")
    for name, first in (("a.tsv", "first a"), ("b.tsv", "first b")):
        (tmp_path / name).write_text(first + "\n" + "\n".join(f"{name} {i}" for i in range(200)))
    got = files.read_headers(spark, str(tmp_path)).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.header) for r in got) == [("a.tsv", "first a"), ("b.tsv", "first b")]
    assert files.read_lines(spark, str(tmp_path)).count() == 400


def test_line_numbers_over_many_splits(spark, tmp_path, conf):
    """Against a plain reader, where a file is read in many pieces and a task reads several files."""
    conf("spark.sql.files.maxPartitionBytes", "64")
    rng, expected, place = random.Random(6), [], 0
    for name in ("a.tsv", "b.tsv", "c.tsv"):
        lines = ["x" * rng.randrange(0, 90) + ("\ty" if rng.random() < 0.7 else "") for _ in range(150)]
        (tmp_path / name).write_text("\n".join(lines) + "\n" * (name != "b.tsv"))
        for number, line in enumerate(lines, 1):
            place += 1
            if "\t" not in line and line:
                expected.append((name, number, place, line))
    for size in ("64", "1m"):
        conf("spark.sql.files.maxPartitionBytes", size)
        lines = files.read_file_lines(spark, str(tmp_path))
        assert (lines.rdd.getNumPartitions() > 20) == (size == "64")
        assert rows_of(quality.located_malformed(lines)) == sorted(expected)


GOOD = "source1_entity_id\tmatched_entity_ids\n"


@pytest.fixture
def required(spark):
    return spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "entity_id string")


def report(spark, required, matching, file="matching", **options):
    found = quality.check_files(spark, matching, required, **options)
    rows = [r for r in found.collect() if r.file == file]
    return {r.rule: (r.severity, r.n, r.examples) for r in rows}


def test_clean_file(spark, required, write):
    path = write("m.tsv", GOOD + "S1-1\tS2-1,S3-1\nS1-2\t\nS1-3\tS2-1\n")
    valid = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    candidates = write("c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\nS1-3\tS2-1,S3-1\n")
    assert report(spark, required, path, candidate_path=candidates, valid_ids=valid) == {}
    assert report(spark, required, path) == {"id_check_off": ("warning", 1, path)}


def test_every_fault_is_found(spark, required, write):
    path = write(
        "m.tsv",
        GOOD + "S1-1\tS2-1,S2-1\nS1-1\tS1-7,X-1\nS1-9\tS2-8\nno tab here  \n\n   \nS1-2\tS2-1\n",
    )
    valid = spark.createDataFrame([("S2-1",)], "entity_id string")
    candidates = write("c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1,S1-7,X-1\nS1-2\t\nS1-3\t\nS1-9\tS2-8\n")
    got = report(spark, required, path, candidate_path=candidates, valid_ids=valid)
    assert got == {
        "duplicate_row": ("error", 1, "S1-1"),
        "repeated_id": ("error", 1, "S1-1"),
        "self_match": ("error", 1, "S1-7"),
        "wrong_prefix": ("error", 1, "X-1"),
        "unknown_id": ("error", 1, "S2-8"),
        "missing_required": ("error", 1, "S1-3"),
        "extra_row": ("error", 1, "S1-9"),
        "malformed_row": ("error", 1, "m.tsv line 5: no tab here"),
        "not_a_candidate": ("warning", 1, "S1-2"),
    }


@pytest.mark.parametrize(
    "text, rule",
    [
        ("source1_entity_id,matched_entity_ids\nS1-1,S2-1\n", "comma_header"),
        ("source1_entity_id\tids\nS1-1\tS2-1\n", "unexpected_header"),
        ("", "file_empty"),
    ],
)
def test_broken_files(spark, required, write, text, rule):
    assert set(report(spark, required, write("m.tsv", text))) == {rule, "id_check_off"}


def test_header_case_and_blanks_do_not_matter(spark, required, write):
    path = write("m.tsv", " Source1_Entity_ID \tMATCHED_entity_ids\nS1-1\t\nS1-2\t\nS1-3\t\n")
    assert set(report(spark, required, path)) == {"id_check_off"}


def test_missing_files(spark, required, write, tmp_path):
    got = report(spark, required, str(tmp_path / "none.tsv"))
    assert set(got) == {"file_missing", "id_check_off"}
    path = write("m.tsv", GOOD + "S1-1\t\nS1-2\t\nS1-3\t\n")
    got = report(spark, required, path, "candidate", candidate_path=str(tmp_path / "none.tsv"))
    assert got["candidates_missing"][0] == "warning"


def test_match_targets_of_files(spark, write, tmp_path):
    s2 = write("s2.tsv", "entity_id\tx\nS2-1\ty\nS2-2\ty\n")
    s3 = write("s3.tsv", "entity_id\tx\nS3-1\ty\nS2-1\ty\n")
    assert rows_of(quality.read_match_targets(spark, s2, s3)) == [("S2-1",), ("S2-2",), ("S3-1",)]
    assert quality.read_match_targets(spark, s2, str(tmp_path / "none.tsv")) is None


def test_candidate_rows_are_checked_under_a_broken_match_file(spark, required, write):
    path = write("m.tsv", "a,b\n")
    candidates = write("c.tsv", "source1_entity_id\tcandidate_entity_ids\r\nS1-1\tS2-1,S2-1\r\nS1-2\tX-2\r\n")
    assert set(report(spark, required, path, candidate_path=candidates)) == {"comma_header", "id_check_off"}
    got = report(spark, required, path, "candidate", candidate_path=candidates)
    assert got == {
        "repeated_id": ("error", 1, "S1-1"),
        "wrong_prefix": ("error", 1, "X-2"),
        "missing_required": ("error", 1, "S1-3"),
    }


def test_report_keeps_counts_and_few_examples(spark):
    found = spark.range(1000).select(F.lit("extra_row").alias("rule"), F.format_string("S1-%04d", "id").alias("offender"))
    assert quality.report(found).first() == ("extra_row", "error", 1000, "S1-0000, S1-0001, S1-0002, S1-0003, S1-0004")


def test_row_numbers(spark):
    ids = spark.range(5000).select(F.format_string("S1-%05d", (F.col("id") * 7919) % 5000).alias("entity_id"))
    numbered = paging.number_rows(ids.repartition(7))
    assert rows_of(numbered) == [(f"S1-{i:05}", i + 1) for i in range(5000)]
    sizes = paging.pages(ids, 900).groupBy("page").count()
    assert rows_of(sizes) == [(0, 900), (1, 900), (2, 900), (3, 900), (4, 900), (5, 500)]


def test_files_with_other_headers_are_not_mixed_up(spark, tmp_path):
    folder = tmp_path / "records"
    folder.mkdir()
    (folder / "a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tAcme\t1 main\tUS\n")
    (folder / "b.tsv").write_text("country\tentity_id\tbusiness_name\tbusiness_address\nUS\tS1-2\tFoo\t2 main\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_records(spark, str(folder)).collect()


def test_only_a_missing_file_switches_the_id_check_off(spark, tmp_path):

    (tmp_path / "s2.tsv").write_text("entity_id\tname\nS2-1\tx\n\nS2-2\ty\n")
    there = str(tmp_path / "s2.tsv")
    assert quality.read_match_targets(spark, there, str(tmp_path / "none")) is None
    assert quality.read_match_targets(spark, there, there).count() == 2
    with pytest.raises(Exception, match="(?i)scheme|nosuch"):
        quality.read_match_targets(spark, there, "nosuch://host/path")


def test_documents_without_a_source_are_in_s3(spark, tmp_path):
    from kindred.sources.tables import line_records

    rows = [(1, "One. two", "en", "src0", 8), (2, "Three. four", "en", None, 11), (3, None, None, "src9", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = {r["entity_id"]: r["source"] for r in line_records(spark, str(tmp_path)).all().collect()}
    assert found == {"S1-000000001-00000": "s1", "S3-000000002-00000": "s3"}


def test_one_record_of_many_words(spark, records):
    from kindred.operators import blocks

    words = " ".join(f"word{k}" for k in range(100_000))
    s1 = records([("S1-1", "us", "acme", words)])
    others = records([("S2-1", "us", "other", "word7 lane", "s2"), ("S3-1", "us", "more", "word7 road", "s3")])
    found = blocks.candidates(s1, others).collect()
    assert [(r[0], r[1], r[2]) for r in found] == [("S1-1", ["S2-1"], ["S3-1"])]


def test_a_key_held_by_a_third_of_all_rows(spark, conf):
    """True pairs and labels of a hot group: no row gathers the group, and the join can be split."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    records = spark.range(3000).select(
        F.concat(F.when(F.col("id") % 30 == 0, "S1-").otherwise("S2-"), "id").alias("entity_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 500)).alias("name"),
        F.lit("us").alias("country"), F.lit("a").alias("address"),
        F.when(F.col("id") % 30 == 0, "s1").otherwise("s2").alias("source"),
    )
    inputs = tables.Sources(records)
    key = tables.copy_key("pages")
    found = labels.true_pairs_by_key(inputs.s1, inputs.others, key)
    plan = plan_of(found)
    assert "collect" not in plan and plan.count("Exchange hashpartitioning") == 2
    names = {r.entity_id: r.name for r in records.collect()}
    expected = sorted((a, b) for a in names for b in names if a[:2] == "S1" and b[:2] == "S2" and names[a] == names[b])
    assert rows_of(found) == expected and len(expected) == 100 * 900
    lists = {r[0]: r[1] for r in tables.truth_lists(inputs, "pages").collect()}
    assert len(lists) == 100 and all(lists[a] == ",".join(sorted(b for x, b in expected if x == a)) for a in lists)


def test_labels_by_lists_equal_labels_by_pairs(spark, records):
    s1 = records([("S1-1", "us", "acme foo", "1 main"), ("S1-2", "us", "acme bar", "2 main")])
    others = records([(f"S{2 + i % 2}-{i}", "us", "acme " + ("foo" if i % 3 else "bar"), f"{i % 3} main", f"s{2 + i % 2}") for i in range(30)])
    groups = blocks.candidates(s1, others)
    truth = spark.createDataFrame(
        [("S1-1", "S2-0, S3-1,S2-4,S9-9"), ("S1-1", "S3-5"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string"
    )
    listed = pairs.group_features(labels.with_truth(groups, truth), s1, others)
    by_pairs = labels.label_pairs(listed.drop("label"), labels.true_pairs(truth)).select(*listed.columns)
    assert rows_of(listed) == rows_of(by_pairs) and listed.filter("label = 1").count() > 1
    assert listed.count() == blocks.explode_groups(groups).count()
