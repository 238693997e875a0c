"""Rules a result file must keep, as checks on tables of lines.

A finding is ``(rule, offender)``: the id or line that breaks the rule, once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.schemas import CANDIDATE_HEADER, MATCH_HEADER
from kindred.session import stage
from kindred.sources.files import body_of, headers_of, read_file_lines, read_ids, with_line_numbers

EXAMPLES = 5

ERROR, WARNING = "error", "warning"
WARNINGS = ["not_a_candidate", "candidates_missing", "id_check_off"]

ROW_RULES = {
    "duplicate_row": "n_rows > 1",
    "repeated_id": "repeated",
    "missing_required": "required AND n_rows = 0",
    "extra_row": "NOT required",
}


# --- parsing ----------------------------------------------------------------


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Lines without a tab; blank ones do not count."""
    return lines.filter(~F.col("value").contains("\t") & F.col("value").rlike(r"\S")).select(
        F.regexp_replace("value", r"\s+$", "").alias("line")
    )


def parsed(lines: DataFrame) -> DataFrame:
    """Every line once: ``source1_entity_id`` and ``ids``, or ``line`` if it is malformed."""
    rest = F.expr("substring(value, instr(value, '\\t') + 1)")
    ids = F.when(rest.rlike(r"\S"), F.split(rest, ",")).otherwise(F.array().cast("array<string>"))
    tabbed = F.col("value").contains("\t")
    return lines.filter(tabbed | F.col("value").rlike(r"\S")).select(
        F.when(tabbed, F.substring_index("value", "\t", 1)).alias("source1_entity_id"),
        F.when(tabbed, ids).alias("ids"),
        F.when(~tabbed, F.regexp_replace("value", r"\s+$", "")).alias("line"),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """``(source1_entity_id, ids)`` of each line with a tab; blank lists have no ids."""
    return parsed(lines).filter("line IS NULL").select("source1_entity_id", "ids")


def located_malformed(lines: DataFrame) -> DataFrame:
    """``(file, line_no, place, line)`` of the malformed lines among ``read_file_lines``."""
    broken = lines.filter(~F.col("value").contains("\t") & F.col("value").rlike(r"\S"))
    return with_line_numbers(broken, lines).select(
        F.element_at(F.split("file", "/"), -1).alias("file"), "line_no", "place",
        F.regexp_replace("value", r"\s+$", "").alias("line"),
    )


def as_lines(lists: DataFrame) -> DataFrame:
    """The lines a two-column list table gives when written."""
    return lists.select(F.concat_ws("\t", *lists.columns).alias("value"))


# --- rules over rows --------------------------------------------------------


def row_findings(rows: DataFrame, required: DataFrame) -> DataFrame:
    """Duplicate, missing and extra rows and lists with a repeated id.

    Rows are folded to one per S1 id before they meet the required ids.
    """
    seen = rows.groupBy("source1_entity_id").agg(
        F.count("*").alias("n_rows"),
        F.max(F.size("ids") != F.size(F.array_distinct("ids"))).alias("repeated"),
    )
    needed = required.select(
        F.col("entity_id").alias("source1_entity_id"), F.lit(True).alias("required")
    ).distinct()
    joined = seen.join(needed, "source1_entity_id", "full").fillna(
        {"n_rows": 0, "repeated": False, "required": False}
    )
    broken = F.array_compact(
        F.array(*[F.when(F.expr(test), rule) for rule, test in ROW_RULES.items()])
    )
    return joined.select(
        F.explode(broken).alias("rule"), F.col("source1_entity_id").alias("offender")
    )


def listed_ids(rows: DataFrame) -> DataFrame:
    """``(source1_entity_id, id)`` for every id of every list."""
    return rows.select("source1_entity_id", F.explode("ids").alias("id"))


def id_findings(rows: DataFrame, valid_ids: DataFrame | None = None) -> DataFrame:
    """S1 ids in lists, ids of no known source, and ids not in ``valid_ids`` if given."""
    ids = listed_ids(rows).select("id").distinct()
    from_s1 = F.col("id").startswith("S1-")
    known_prefix = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    rule = F.when(from_s1, "self_match").when(~known_prefix, "wrong_prefix")
    if valid_ids is not None:
        valid = valid_ids.select(F.col("entity_id").alias("id"), F.lit(True).alias("valid"))
        ids = ids.join(valid.distinct(), "id", "left")
        rule = rule.when(F.col("valid").isNull(), "unknown_id")
    return ids.select(rule.alias("rule"), F.col("id").alias("offender")).filter("rule IS NOT NULL")


def _list_sums(rows: DataFrame, size: Callable[[str], Column]) -> DataFrame:
    """``(source1_entity_id, n, low, high, least, most)``: a size of each entity's lists without repeated
    ids, the least and greatest digest of them, equal if all lists are, and their least and greatest id."""
    ids = F.array_distinct("ids")
    digest = F.md5(F.array_join(ids, ",")).alias("digest")
    ends = F.array_min("ids").alias("least"), F.array_max("ids").alias("most")
    sums = rows.select("source1_entity_id", F.size(ids).cast("bigint").alias("n"), digest, *ends)
    return sums.groupBy("source1_entity_id").agg(
        size("n").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.min("least").alias("least"), F.max("most").alias("most")
    )


def subset_findings(rows: DataFrame, candidate_rows: DataFrame) -> DataFrame:
    """S1 entities with a match that is not among their candidates.

    Sizes, digests and ends of lists are moved instead of their ids, and decide nearly all entities: a
    list longer than all candidates holds another id, so does one with an id before the first or after the
    last of them, and a list equal to that of the candidates holds none. Only the ids of the entities
    that are left, if any, are compared, once these are staged.
    """
    names = "source1_entity_id", "listed", "first", "last", "from", "to"
    sums = _list_sums(rows, F.max).filter("n > 0").join(_list_sums(candidate_rows, F.sum).toDF(*names), names[0], "left")
    longer = F.col("n") > F.coalesce("listed", F.lit(0))
    beyond = (F.col("least") < F.col("from")) | (F.col("most") > F.col("to"))
    equal = (F.col("low") == F.col("high")) & (F.col("low") == F.col("first")) & (F.col("first") == F.col("last"))
    verdict = F.when(longer, True).when(equal, False).alias("outside")
    judged = sums.select("source1_entity_id", verdict, F.coalesce(beyond, F.lit(False)).alias("beyond"))
    judged = stage(judged.filter("coalesce(outside, true)"), "judged")
    outside = judged.filter("outside OR beyond").select("source1_entity_id")
    left = judged.filter("outside IS NULL AND NOT beyond").select("source1_entity_id")
    if not left.isEmpty():
        ids, candidate_ids = (listed_ids(r.join(left, "source1_entity_id", "left_semi")) for r in (rows, candidate_rows))
        compared = ids.distinct().join(candidate_ids, ["source1_entity_id", "id"], "left_anti")
        outside = outside.unionByName(compared, allowMissingColumns=True)
    return outside.select(
        F.lit("not_a_candidate").alias("rule"), F.col("source1_entity_id").alias("offender")
    ).distinct()


def row_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.size("ids") == 0).alias("empty_rows"),
        F.count_if(F.size("ids") > 0).alias("non_empty_rows"),
    )


def match_targets(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """Distinct ids of S2 and S3."""
    return s2.select("entity_id").union(s3.select("entity_id")).distinct()


def read_match_targets(spark: SparkSession, s2_path: str, s3_path: str) -> DataFrame | None:
    """The same from source files; None, which leaves the id check out, if one is missing."""
    try:
        return match_targets(read_ids(spark, s2_path), read_ids(spark, s3_path))
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return None


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


# --- files ------------------------------------------------------------------


def header_findings(headers: DataFrame, expected: list[str]) -> DataFrame:
    """Files whose header has commas and no tab, or is not the expected one."""
    names = F.transform(F.split("header", "\t"), lambda c: F.lower(F.trim(c)))
    commas = ~F.col("header").contains("\t") & F.col("header").contains(",")
    wrong = names != F.array(*[F.lit(c) for c in expected])
    rule = F.when(commas, "comma_header").when(wrong, "unexpected_header")
    return headers.select(rule.alias("rule"), F.col("header").alias("offender")).filter(
        "rule IS NOT NULL"
    )


def file_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """All lines of the files in ``path``, read where they lie; None if there is none."""
    try:
        return read_file_lines(spark, path)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return None


def file_findings(spark: SparkSession, path: str, expected: list[str], headers: DataFrame | None) -> DataFrame:
    """A missing or empty file, or a broken header, from the ``headers`` of its files."""
    if headers is None:
        return spark.createDataFrame([("file_missing", path)], "rule string, offender string")
    empty = (
        headers.agg(F.count("*").alias("n"))
        .filter("n = 0")
        .select(F.lit("file_empty").alias("rule"), F.lit(path).alias("offender"))
    )
    # A header is named once, however many files of the listing have it.
    return header_findings(headers, expected).distinct().unionByName(empty)


# --- report -----------------------------------------------------------------


def findings(
    lines: DataFrame, required: DataFrame, valid_ids: DataFrame | None = None
) -> DataFrame:
    """All findings on the lines of one file."""
    return parsed_findings(stage(parsed(lines), "parsed"), required, valid_ids)


def parsed_findings(
    found: DataFrame, required: DataFrame, valid_ids: DataFrame | None = None, located: DataFrame | None = None
) -> DataFrame:
    """The same from ``parsed`` lines. Malformed ones are named by their text, or, if
    ``located`` in files, by file and line as well."""
    rows = found.filter("line IS NULL").select("source1_entity_id", "ids")
    offender, broken = F.col("line"), found.filter("line IS NOT NULL")
    if located is not None:
        offender, broken = F.concat("file", F.lit(" line "), "line_no", F.lit(": "), "line"), located
    malformed = broken.select(F.lit("malformed_row").alias("rule"), offender.alias("offender"))
    return row_findings(rows, required).unionByName(id_findings(rows, valid_ids)).unionByName(malformed)


def report(found: DataFrame) -> DataFrame:
    """``(rule, severity, n, examples)``, after ``file`` if findings name one: the count
    of each rule's offenders and the first few in order.

    Findings are spread by rule and offender once; count and examples both read that
    exchange. Only the first few of a rule leave each task.
    """
    by = [c for c in ("file", "rule") if c in found.columns]
    found = found.repartition(*by, "offender")
    order = Window.partitionBy(*by).orderBy("offender")
    examples = (
        found.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= EXAMPLES)
        .groupBy(*by)
        .agg(F.array_join(F.sort_array(F.collect_list("offender")), ", ").alias("examples"))
    )
    severity = F.when(F.col("rule").isin(WARNINGS), WARNING).otherwise(ERROR)
    return (
        found.groupBy(*by)
        .agg(F.count("*").alias("n"))
        .join(examples, by)
        .select(*by, severity.alias("severity"), "n", "examples")
    )


def check_files(
    spark: SparkSession,
    matching_path: str,
    required: DataFrame,
    candidate_path: str | None = None,
    valid_ids: DataFrame | None = None,
) -> DataFrame:
    """The report on a written match file and, if named, candidate file.

    The rows of a file with a broken header are not looked at. A missing candidate file
    and a skipped id check are warnings.
    """
    expected = {"matching": (matching_path, MATCH_HEADER)}
    if candidate_path:
        expected["candidate"] = (candidate_path, CANDIDATE_HEADER)
    lines: dict[str, DataFrame] = {}
    found: list[DataFrame] = []
    for file, (path, header) in expected.items():
        own = file_lines(spark, path)
        # A row per file, staged: the files are not read again for it.
        headers = None if own is None else stage(headers_of(own), "headers")
        trouble = file_findings(spark, path, header, headers)
        first = trouble.first()
        if first is None:
            # Not staged: the files hold all of it, and a copy takes as much disk again.
            lines[file] = parsed(body_of(own, headers))
            located = located_malformed(own).filter("line_no > 1")
            trouble = parsed_findings(lines[file], required, valid_ids, located)
        elif file == "candidate" and first.rule == "file_missing":
            trouble = trouble.withColumn("rule", F.lit("candidates_missing"))
        found.append(trouble.withColumn("file", F.lit(file)))
    if len(lines) == 2:
        outside = subset_findings(*[lines[f].filter("line IS NULL") for f in expected])
        found.append(outside.withColumn("file", F.lit("matching")))
    if valid_ids is None:
        note = [("id_check_off", matching_path, "matching")]
        found.append(spark.createDataFrame(note, "rule string, offender string, file string"))
    return report(reduce(DataFrame.unionByName, found))
