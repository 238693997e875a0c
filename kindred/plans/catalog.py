"""Every operator as a query over the benchmark tables.

Queries that give one row per pair read the ``pages`` records, all others the
``documents`` lines (see ``kindred.sources.tables``); both tables are read whole. Where the
variants of an operator differ only on missing fields, ``gaps`` leaves some out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.operators import blocks, boosting, evaluate, keys, labels, lists, model, pairs, paging, quality
from kindred.schemas import CANDIDATE_HEADER, FEATURES, MATCH_HEADER, PAIR_KEYS
from kindred.session import shuffles_freed, stage, work_path
from kindred.sources import files
from kindred.plans import linkage
from kindred.sources.tables import DATASETS, Sources, copy_key, listed, sources, truth_entities, truth_lists

PAGES, DOCUMENTS, GAPS = "pages", "documents", "gaps"
THRESHOLD = 0.5
CAP_20 = 20
CAP_3 = 3
PAGE_SIZE = 500
FIRST_ROW, LAST_ROW = 501, 1000
LIMIT = 100

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(dataset: str | None = None, name: str | None = None, once: bool = False, **options):
    """Register a function of the normalised sources of ``dataset``, or, without one, of
    the session and the folder of the tables. Records are written before use, so that the
    table is read and normalised once, unless the query reads them ``once`` anyway."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if dataset is None:
                return function(spark, sf_dir)
            return function(sources(spark, sf_dir, dataset, staged=not once, **options))

        QUERIES[name or function.__name__] = run
        return function

    return register


def _spark(inputs: Sources) -> SparkSession:
    return inputs.s1.sparkSession


def _groups(inputs: Sources, **options) -> DataFrame:
    return blocks.candidates(inputs.s1, inputs.others, **options)


def _truth(inputs: Sources, dataset: str) -> DataFrame:
    return labels.true_pairs_by_key(inputs.s1, inputs.others, copy_key(dataset))


def _counts(inputs: Sources, dataset: str) -> DataFrame:
    return labels.true_counts(inputs.s1, inputs.others, copy_key(dataset))


def _labelled(inputs: Sources, dataset: str, **options) -> DataFrame:
    return labels.label_by_key(_groups(inputs, **options), inputs.s1, inputs.others, copy_key(dataset))


def _met(inputs: Sources, dataset: str, **options) -> DataFrame:
    """Counts of labelled pairs per entity: what only counts needs no pairs."""
    return labels.met_by_key(inputs.s1, inputs.others, copy_key(dataset), **options)


def _features(inputs: Sources, guard_empty: bool = True) -> DataFrame:
    return pairs.block_features(inputs.s1, inputs.others, guard_empty)


def _labelled_features(inputs: Sources, dataset: str) -> DataFrame:
    """Labelled rows: the label comes from the keys both sides bring along."""
    return pairs.block_features(inputs.s1, inputs.others, key=copy_key(dataset))


def _scored(inputs: Sources) -> DataFrame:
    return pairs.rule_score(_features(inputs))


def _matches(inputs: Sources) -> DataFrame:
    return pairs.accepted(_scored(inputs), THRESHOLD)


# --- scans ------------------------------------------------------------------


@query()
def scan_sources(spark, sf_dir):
    return DATASETS[DOCUMENTS](spark, sf_dir).all()


@query()
def scan_pages(spark, sf_dir):
    return DATASETS[PAGES](spark, sf_dir).all()


@query()
def tsv_roundtrip(spark, sf_dir):
    path = work_path(spark, "records")
    records = DATASETS[DOCUMENTS](spark, sf_dir).all()
    files.write_tsv(records.drop("source"), path)
    return files.read_records(spark, path)


@query()
def source_counts(spark, sf_dir):
    return DATASETS[DOCUMENTS](spark, sf_dir).all().groupBy("source").agg(F.count("*").alias("n"))


@query(DOCUMENTS, once=True)
def limit_source(inputs):
    return paging.first_rows(inputs.s1, LIMIT)


@query(DOCUMENTS, once=True)
def s1_pages(inputs):
    return paging.pages(inputs.s1, PAGE_SIZE)


@query(DOCUMENTS, once=True)
def s1_row_range(inputs):
    return paging.rows_between(inputs.s1.select("entity_id"), FIRST_ROW, LAST_ROW)


@query(DOCUMENTS, once=True)
def candidate_records(inputs):
    split = {t: inputs.others.filter(F.col("source") == t).drop("source") for t in ("s2", "s3")}
    return pairs.candidate_records(split["s2"], split["s3"])


@query(DOCUMENTS, once=True)
def match_targets(inputs):
    s2, s3 = (inputs.others.filter(F.col("source") == t) for t in ("s2", "s3"))
    return quality.match_targets(s2, s3)


# --- normalisers ------------------------------------------------------------


@query(DOCUMENTS, once=True)
def normalize_basic(inputs):
    return inputs.all()


@query(DOCUMENTS, once=True, normalizer="rich")
def normalize_rich(inputs):
    return inputs.all()


def _normalizer(name: str, field: str, form: Callable[[Column], Column]) -> None:
    def run(spark, sf_dir):
        records = DATASETS[DOCUMENTS](spark, sf_dir).all()
        return records.select("entity_id", form(F.col(field)).alias("normal"))

    QUERIES[name] = run


def _listed(form: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda c: F.array_join(form(c), ",")


_normalizer("normalize_text", "business_name", text.rich_text)
_normalizer("normalize_name", "business_name", text.rich_name)
_normalizer("normalize_name_core", "business_name", text.core_name)
_normalizer("normalize_address", "business_address", text.rich_address)
_normalizer("normalize_country", "country", text.rich_text)
_ASCII = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)]))
_WIDE = "".join(chr(ord(c) + 0xFEE0) for c in _ASCII)


def _full_width(form: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """A form of a field whose ASCII letters and digits are written full-width: compatible
    composition makes them plain again, so the result is that of the field itself."""
    return lambda c: form(F.translate(c, _ASCII, _WIDE))


_normalizer("normalize_text_wide", "business_name", _full_width(text.rich_text))
_normalizer("normalize_address_wide", "business_address", _full_width(text.rich_address))
_normalizer("address_token_array", "business_address", _listed(text.address_words))
_normalizer("address_numbers", "business_address", _listed(text.address_numbers))


# --- words, keys, blocks ----------------------------------------------------


@query(DOCUMENTS, once=True)
def name_tokens(inputs):
    return keys.field_words(inputs.all(), "name")


@query(DOCUMENTS, once=True)
def address_tokens(inputs):
    return keys.field_words(inputs.all(), "address")


@query(DOCUMENTS, once=True)
def rare_name_tokens(inputs):
    return keys.rare_words(inputs.others, "name")


@query(DOCUMENTS, once=True)
def rare_address_tokens(inputs):
    return keys.rare_words(inputs.others, "address")


@query(DOCUMENTS, once=True)
def keys_basic(inputs):
    return keys.basic_keys(inputs.all())


@query(PAGES)
def keys_basic_pages(inputs):
    return keys.basic_keys(inputs.all())


@query(DOCUMENTS, once=True)
def keys_basic_unguarded(inputs):
    return keys.basic_keys(inputs.all(), guard_empty=False)


@query(DOCUMENTS)
def keys_rare_name(inputs):
    rare = keys.rare_words(inputs.others, "name")
    return keys.rare_keys(inputs.all(), rare, keys.NAME_WORD)


@query(DOCUMENTS)
def keys_rare_address(inputs):
    rare = keys.rare_words(inputs.others, "address")
    return keys.rare_keys(inputs.all(), rare, keys.ADDRESS_WORD)


@query(DOCUMENTS)
def keys_all(inputs):
    return keys.all_keys(inputs.all(), inputs.others)


@query(PAGES)
def keys_all_unguarded(inputs):
    return keys.all_keys(inputs.all(), inputs.others, guard_empty=False)


@query(DOCUMENTS)
def block_sizes(inputs):
    return blocks.block_sizes(keys.all_keys(inputs.others, inputs.others))


def _block_lists(built: DataFrame) -> DataFrame:
    return blocks.by_source(built, "key_type", "block_key").select(
        "key_type",
        "block_key",
        "source",
        F.array_join(F.sort_array("entity_ids"), ",").alias("entity_ids"),
    )


@query(DOCUMENTS, name="blocks")
def block_lists(inputs):
    return _block_lists(blocks.build_blocks(inputs.others))


@query(DOCUMENTS)
def blocks_cap20(inputs):
    return _block_lists(blocks.build_blocks(inputs.others, cap=CAP_20))


@query(PAGES)
def candidate_pairs(inputs):
    return blocks.explode_groups(_groups(inputs))


@query(PAGES)
def candidate_pairs_cap20(inputs):
    return blocks.explode_groups(_groups(inputs, cap=CAP_20))


@query(GAPS)
def candidate_pairs_gaps(inputs):
    return blocks.explode_groups(_groups(inputs))


@query(GAPS)
def candidate_pairs_unguarded(inputs):
    return blocks.explode_groups(_groups(inputs, guard_empty=False))


@query(DOCUMENTS)
def candidate_lists(inputs):
    return lists.candidate_lists(_groups(inputs), inputs.s1)


@query(DOCUMENTS)
def candidate_lists_cap20(inputs):
    return lists.candidate_lists(_groups(inputs, cap=CAP_20), inputs.s1)


@query(DOCUMENTS)
def candidate_lists_per_source(inputs):
    return lists.candidate_lists(_groups(inputs), inputs.s1, per_source=True)


# --- truth and labels -------------------------------------------------------


@query(DOCUMENTS)
def true_pairs(inputs):
    return _truth(inputs, DOCUMENTS)


@query(DOCUMENTS)
def truth_semi(inputs):
    # Entities are picked before they get their lists, which need not be moved for it.
    with_address = inputs.s1.filter("address <> ''")
    kept = labels.restrict_truth(truth_entities(inputs, DOCUMENTS), with_address)
    return listed(kept, inputs, DOCUMENTS).drop("records")


@query(PAGES)
def label_pairs(inputs):
    return _labelled(inputs, PAGES)


@query(DOCUMENTS)
def label_counts(inputs):
    return labels.label_counts(_met(inputs, DOCUMENTS))


@query(DOCUMENTS)
def entity_split(inputs):
    # A group is a set of pairs of one entity, so the split needs no pairs.
    return labels.entity_split(_groups(inputs))


@query(PAGES)
def entity_split_rows(inputs):
    return labels.with_split(_labelled(inputs, PAGES)).filter("split = 'validation'")


# --- features ---------------------------------------------------------------


@query(PAGES)
def pair_features(inputs):
    return _features(inputs)


@query(PAGES)
def pair_features_unguarded(inputs):
    return _features(inputs, guard_empty=False)


@query(GAPS)
def pair_features_gaps(inputs):
    return _features(inputs)


@query(GAPS, fill_missing=True)
def pair_features_filled(inputs):
    return _features(inputs)


@query(PAGES)
def labelled_features(inputs):
    return _labelled_features(inputs, PAGES)


def _totals(features: DataFrame) -> DataFrame:
    """Sums of every feature per S1 entity; ratios rounded pair by pair to whole
    millionths so that the order of adding does not matter."""

    def total(f):
        value = F.col(f)
        if f.endswith("_ratio"):
            value = F.round(value * 1000000).cast("bigint")
        return F.sum(value).alias(f)

    return features.groupBy("source1_entity_id").agg(
        F.count("*").alias("pairs"), *[total(f) for f in FEATURES]
    )


@query(DOCUMENTS)
def feature_totals(inputs):
    return _totals(_features(inputs))


@query(DOCUMENTS)
def feature_totals_unguarded(inputs):
    return _totals(_features(inputs, guard_empty=False))


@query(DOCUMENTS, fill_missing=True)
def feature_totals_filled(inputs):
    return _totals(_features(inputs))


@query(PAGES)
def feature_roundtrip(inputs):
    spark = _spark(inputs)
    path = work_path(spark, "features")
    files.write_parquet(_labelled_features(inputs, PAGES), path)
    return spark.read.parquet(path)


# --- evaluation -------------------------------------------------------------


def _per_s1(inputs: Sources, **options) -> DataFrame:
    return evaluate.truth_per_s1(_met(inputs, DOCUMENTS, count_all=False, **options), _counts(inputs, DOCUMENTS))


def _recall_queries(suffix: str, **options) -> None:
    """Blocking recall under a cap of blocks. With few records per block some true pairs are
    lost, and some entities find a part of theirs."""

    @query(DOCUMENTS, name=f"pair_recall{suffix}")
    def pair_recall(inputs):
        met = _met(inputs, DOCUMENTS, count_all=False, **options)
        return evaluate.pair_recall(met, _counts(inputs, DOCUMENTS))

    @query(DOCUMENTS, name=f"entities_any_match{suffix}")
    def entities_any_match(inputs):
        return _per_s1(inputs, **options).filter("n_found > 0").select("source1_entity_id")

    @query(DOCUMENTS, name=f"entities_all_match{suffix}")
    def entities_all_match(inputs):
        return _per_s1(inputs, **options).filter("n_found = n_true").select("source1_entity_id")

    @query(DOCUMENTS, name=f"blocking_metrics{suffix}")
    def blocking_metrics(inputs):
        return evaluate.blocking_metrics(inputs.s1, _met(inputs, DOCUMENTS, **options), _counts(inputs, DOCUMENTS))


_recall_queries("")
_recall_queries("_cap3", cap=CAP_3)


@query(DOCUMENTS)
def candidates_per_s1(inputs):
    return evaluate.candidates_per_s1(inputs.s1, _groups(inputs))


@query(DOCUMENTS)
def zero_candidate_s1(inputs):
    return evaluate.zero_candidate_s1(inputs.s1, _groups(inputs))


@query(DOCUMENTS)
def blocking_summary(inputs):
    return evaluate.blocking_summary(inputs.s1, inputs.others, _groups(inputs))


@query(PAGES)
def threshold_filter(inputs):
    return _matches(inputs).select(*PAIR_KEYS, "probability")


def _labelled_scores(inputs: Sources) -> DataFrame:
    return pairs.rule_score(_labelled_features(inputs, DOCUMENTS))


@query(DOCUMENTS)
def threshold_sweep(inputs):
    return evaluate.threshold_sweep(_labelled_scores(inputs))


@query(DOCUMENTS)
def threshold_sweep_validation(inputs):
    """The sweep as training runs it: on the pairs of the validation entities."""
    held_out = inputs.s1.filter(labels.split_of(F.col("entity_id")) == "validation")
    rows = pairs.block_features(held_out, inputs.others, key=copy_key(DOCUMENTS))
    return evaluate.threshold_sweep(pairs.rule_score(rows))


@query(DOCUMENTS)
def best_threshold(inputs):
    return evaluate.best_threshold(evaluate.threshold_sweep(_labelled_scores(inputs)))


def _labelled_matches(inputs: Sources) -> DataFrame:
    return pairs.accepted(_labelled_scores(inputs), THRESHOLD)


@query(DOCUMENTS)
def entity_f05(inputs):
    return evaluate.entity_f05(inputs.s1, _labelled_matches(inputs), _counts(inputs, DOCUMENTS))


@query(DOCUMENTS)
def macro_f05(inputs):
    found = evaluate.macro_f05(inputs.s1, _labelled_matches(inputs), _counts(inputs, DOCUMENTS))
    return found.withColumn("macro_f05", F.round("macro_f05", 9))


# --- output -----------------------------------------------------------------


@query(DOCUMENTS)
def result_lists(inputs):
    return lists.result_lists(_matches(inputs), inputs.s1)


@query(PAGES)
def result_lists_pages(inputs):
    return lists.result_lists(_matches(inputs), inputs.s1)


@query(DOCUMENTS)
def predict_summary(inputs):
    return evaluate.predict_summary(inputs.s1, _scored(inputs), THRESHOLD)


# --- quality ----------------------------------------------------------------


def _faulty_lines(inputs: Sources) -> DataFrame:
    """Lines of a result file with faults put in: the truth lists, broken according to
    the country and fields of the record."""
    fields = "country", F.length("name").alias("letters")
    lists = listed(truth_entities(inputs, DOCUMENTS, *fields), inputs, DOCUMENTS)
    rows = lists.filter("source1_entity_id IS NOT NULL").select(
        "source1_entity_id", F.explode("records").alias("record"), F.col("matched_entity_ids").alias("ids")
    )
    country, letters, ids = F.col("record.country"), F.col("record.letters"), F.col("ids")
    broken = (
        F.when((country == "de") & (ids != ""), F.concat(ids, F.lit(","), ids))
        .when(country == "fr", F.concat_ws(",", F.nullif(ids, F.lit("")), "source1_entity_id"))
        .when(letters > 150, F.concat(F.lit("X-"), "source1_entity_id"))
        .otherwise(ids)
    )
    # Kept rows, some of them twice.
    written = F.when(country == "es", F.array(broken, ids)).otherwise(F.array(broken))
    kept = rows.filter(letters >= 5).select("source1_entity_id", F.explode(written).alias("ids"))
    extra = inputs.others.filter("source = 's2' AND country = 'es'").select(
        F.col("entity_id").alias("source1_entity_id"), F.lit("").alias("ids")
    )
    no_tab = inputs.others.filter("source = 's3' AND country = 'fr'").select(
        F.concat(F.lit("note "), "entity_id").alias("value")
    )
    return quality.as_lines(kept.unionByName(extra)).unionByName(no_tab)


def _candidate_lines(inputs: Sources) -> DataFrame:
    """Lines of a candidate file that knows only the S2 ids of the truth."""
    truth = truth_lists(inputs, DOCUMENTS)
    s2_only = F.regexp_replace("matched_entity_ids", ",?S3-.*$", "")
    return quality.as_lines(truth.select("source1_entity_id", s2_only.alias("ids")))


def _valid_ids(inputs: Sources) -> DataFrame:
    return inputs.others.filter("address IS NOT NULL")


def _findings(inputs: Sources) -> DataFrame:
    # Not staged: the lists would be written, and making them again is cheaper.
    found = quality.parsed(_faulty_lines(inputs))
    outside = quality.subset_findings(
        found.filter("line IS NULL"), quality.parse_lines(_candidate_lines(inputs))
    )
    return quality.parsed_findings(found, inputs.s1, _valid_ids(inputs)).unionByName(outside)


def _rule_query(name: str, rule: str) -> None:
    def run(spark, sf_dir):
        inputs = sources(spark, sf_dir, DOCUMENTS, staged=True)
        rows = quality.parse_lines(_faulty_lines(inputs))
        if rule in quality.ROW_RULES:
            found = quality.row_findings(rows, inputs.s1)
        else:
            found = quality.id_findings(rows, _valid_ids(inputs))
        return found.filter(F.col("rule") == rule).select("offender")

    QUERIES[name] = run


_rule_query("dq_duplicate_rows", "duplicate_row")
_rule_query("dq_intra_dupes", "repeated_id")
_rule_query("dq_missing_required", "missing_required")
_rule_query("dq_extra_rows", "extra_row")
_rule_query("dq_self_match", "self_match")
_rule_query("dq_wrong_prefix", "wrong_prefix")
_rule_query("dq_unknown_ids", "unknown_id")


@query(DOCUMENTS)
def dq_malformed(inputs):
    return quality.malformed_lines(_faulty_lines(inputs))


@query(DOCUMENTS)
def dq_malformed_lines(inputs):
    """Malformed lines of a sorted listing in files, with their places in it."""
    path = work_path(_spark(inputs), "listing")
    files.write_lines(_faulty_lines(inputs), path)
    return quality.located_malformed(files.read_file_lines(_spark(inputs), path)).select("place", "line")


@query(DOCUMENTS)
def dq_match_subset(inputs):
    rows, candidate_rows = map(
        quality.parse_lines, (_faulty_lines(inputs), _candidate_lines(inputs))
    )
    return quality.subset_findings(rows, candidate_rows).select("offender")


@query(DOCUMENTS)
def dq_row_stats(inputs):
    return quality.row_stats(quality.parse_lines(_faulty_lines(inputs)))


@query(DOCUMENTS)
def dq_report(inputs):
    return quality.report(_findings(inputs))


@query(DOCUMENTS)
def dq_header(inputs):
    """Headers of written files: candidate lists where match lists are expected, and the
    same lists separated by commas."""
    spark = _spark(inputs)
    rows = truth_lists(inputs, DOCUMENTS).toDF(*CANDIDATE_HEADER)
    tabs, commas = work_path(spark, "tabs"), work_path(spark, "commas")
    files.write_tsv(rows, tabs, compression="gzip")
    with shuffles_freed(spark):
        rows.write.options(header="true", compression="gzip").csv(commas)
    checks = [
        quality.header_findings(headers, expected)
        for headers in [stage(files.read_headers(spark, path), "headers") for path in (tabs, commas)]
        for expected in (MATCH_HEADER, CANDIDATE_HEADER)
    ]
    found = checks[0]
    for check in checks[1:]:
        found = found.unionByName(check)
    return found.distinct()


@query(DOCUMENTS)
def dq_files(inputs):
    """The report on files of match and candidate lists written and read back."""
    spark = _spark(inputs)
    truth = truth_lists(inputs, DOCUMENTS)
    s2_only = F.regexp_replace("matched_entity_ids", ",?S3-.*$", "")
    candidate_rows = truth.select("source1_entity_id", s2_only.alias("candidate_entity_ids"))
    paths = work_path(spark, "matches"), work_path(spark, "candidates")
    files.write_tsv(truth, paths[0], compression="gzip")
    files.write_tsv(candidate_rows, paths[1], compression="gzip")
    return quality.check_files(spark, paths[0], inputs.s1, paths[1], _valid_ids(inputs))


@query(DOCUMENTS)
def dq_file_faults(inputs):
    """Findings on files that are missing, empty or separated by commas, with a candidate
    file that is absent, and with a source file missing for the check of ids."""
    spark = _spark(inputs)
    truth = truth_lists(inputs, DOCUMENTS)
    at = {name: work_path(spark, name) for name in ("matches", "empty", "commas", "nowhere", "s2")}
    files.write_tsv(truth, at["matches"], compression="gzip")
    spark.createDataFrame([], "value string").write.text(at["empty"])
    with shuffles_freed(spark):
        truth.write.options(header="true", compression="gzip").csv(at["commas"])
    files.write_tsv(inputs.others.filter("source = 's2'").select("entity_id", "name"), at["s2"])
    unchecked = quality.read_match_targets(spark, at["s2"], at["nowhere"])
    checked = quality.read_match_targets(spark, at["s2"], at["s2"])
    cases = {
        "missing": (at["nowhere"], None, checked),
        "empty": (at["empty"], None, checked),
        "commas": (at["commas"], None, checked),
        "no candidates": (at["matches"], at["nowhere"], checked),
        "no ids": (at["matches"], None, unchecked),
    }
    found = None
    for case, (path, candidates, ids) in cases.items():
        report = quality.check_files(spark, path, inputs.s1, candidates, ids)
        rows = report.select(F.lit(case).alias("case"), "file", "rule", "severity", "n")
        found = rows if found is None else found.unionByName(rows)
    return found


# --- files --------------------------------------------------------------------


def _written_sources(inputs: Sources) -> list[str]:
    """Paths of the three sources as files."""
    paths = []
    for tag in ("s1", "s2", "s3"):
        rows = inputs.records.filter(F.col("source") == tag).drop("source")
        paths.append(work_path(_spark(inputs), tag))
        files.write_tsv(rows, paths[-1])
    return paths


def _raw(spark: SparkSession, sf_dir: str) -> Sources:
    return DATASETS[DOCUMENTS](spark, sf_dir).even().staged()


@query()
def file_ids(spark, sf_dir):
    """Ids in the first column of a written source file."""
    return files.read_ids(spark, _written_sources(_raw(spark, sf_dir))[0])


@query()
def file_match_targets(spark, sf_dir):
    _, s2, s3 = _written_sources(_raw(spark, sf_dir))
    return quality.read_match_targets(spark, s2, s3)


@query(DOCUMENTS)
def file_truth(inputs):
    """True pairs of the S1 entities with an address, from a written truth file."""
    path = work_path(_spark(inputs), "truth")
    files.write_tsv(truth_lists(inputs, DOCUMENTS), path, compression="gzip")
    truth = files.read_truth(_spark(inputs), path)
    return labels.true_pairs(labels.restrict_truth(truth, inputs.s1.filter("address <> ''")))


@query()
def file_pipeline(spark, sf_dir):
    """Source files linked to files of matches and candidates, and both read back."""
    matches, candidates = work_path(spark, "matches"), work_path(spark, "candidates")
    linkage.link_files_by_rule(spark, *_written_sources(_raw(spark, sf_dir)), matches, candidates, THRESHOLD)
    found = files.read_truth(spark, matches)
    # Matches are few next to candidates, whose lists then need not be sorted to meet them.
    found = found.hint("shuffle_hash")
    lines = quality.parse_lines(files.read_lines(spark, candidates))
    listed = lines.select("source1_entity_id", F.array_join("ids", ",").alias("candidate_entity_ids"))
    return found.join(listed, "source1_entity_id").select(
        "source1_entity_id", F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"),
        "candidate_entity_ids",
    )


# --- model ------------------------------------------------------------------


def _staged_features(inputs: Sources) -> DataFrame:
    """Labelled features, some of them NULL, dealt out evenly and stored by split."""
    rows = labels.with_split(_labelled_features(inputs, GAPS))
    return stage(rows.hint("rebalance"), "features", "split")


def _constant_f05() -> Column:
    """F0.5 of taking every pair for a match, the best a rule without features can do."""
    positive = F.sum(F.col("label"))
    return F.coalesce(evaluate.f_half(positive, F.count("*") - positive, F.lit(0)), F.lit(0.0))


@query(GAPS)
def gbt_score(inputs):
    """What holds of a trained matcher whatever its trees: it scores every pair between 0
    and 1, no entity is on both sides of the split, and on the validation entities it is
    no worse than a constant answer."""
    rows = _staged_features(inputs)
    matcher, sweep = model.train(rows)
    scored = stage(model.score_pairs(matcher, rows), "scored")
    sides = scored.groupBy("source1_entity_id").agg(F.count_distinct("split").alias("n")).agg(
        F.coalesce(F.max("n") == 1, F.lit(True)).alias("entities_on_one_side")
    )
    constant = rows.filter("split = 'validation'").agg(_constant_f05().alias("constant"))
    best = evaluate.best_threshold(sweep).select("best_f05")
    totals = scored.agg(
        F.count("*").alias("pairs"),
        F.count_if(F.col("split") == "validation").alias("validation_pairs"),
        F.count_if(F.col("label") == 1).alias("positive_pairs"),
        F.count_if(F.col("probability").between(0, 1)).alias("scored_pairs"),
    )
    gaps = rows.agg(F.count_if(F.col("name_length_diff").isNull()).alias("pairs_without_length"))
    # Tables of one row each.
    joined = totals.withColumn("one", F.lit(1))
    for other in (sides, constant, best, gaps):
        joined = joined.join(other.withColumn("one", F.lit(1)), "one")
    return joined.select(
        "pairs", "validation_pairs", "positive_pairs", "pairs_without_length", "scored_pairs",
        "entities_on_one_side", (F.col("best_f05") >= F.col("constant") - 1e-9).alias("as_good_as_constant"),
    )


@query(GAPS)
def gbt_roundtrip(inputs):
    """A matcher fitted on the train entities, saved and loaded: the same nodes, the threshold
    chosen on the validation entities, and the same score of every pair."""
    spark = _spark(inputs)
    rows = _staged_features(inputs)
    path = work_path(spark, "matcher")
    matcher, sweep = model.train(rows)
    model.save_matcher(matcher, path)
    loaded = model.load_matcher(spark, path)
    chosen = evaluate.best_threshold(sweep).first().best_threshold
    # Both score a row where it is: rows are read once, and one exchange brings equal pairs together.
    scored = model.score_pairs(matcher, rows).withColumnRenamed("probability", "before")
    again = model.score_pairs(loaded, scored).withColumnRenamed("probability", "after").dropna(subset=PAIR_KEYS)
    met = again.groupBy(*PAIR_KEYS).agg(F.collect_list(F.struct("before", "after")).alias("scores"))
    size, none = F.size("scores").cast("bigint"), F.lit(0).cast("bigint")
    equal = F.aggregate("scores", none, lambda n, x: n + F.size(F.filter("scores", lambda y: y["after"] == x["before"])))
    unscored = F.size(F.filter("scores", lambda y: (y["after"] >= loaded.threshold) & y["after"].isNull()))

    def total(value):
        return F.coalesce(F.sum(value), none)

    return met.agg(
        total(size * size).alias("pairs"),
        total(equal).alias("equal_scores"),
        F.lit(loaded.threshold == chosen).alias("threshold_kept"),
        F.lit(loaded.features == matcher.features).alias("features_kept"),
        total(size * unscored).alias("accepted_without_score"),
        F.lit(loaded.forest == matcher.forest).alias("forest_kept"),
    )


@query(GAPS)
def gbt_first_splits(inputs):
    """The gain of the best split on each feature, with missing values on either side."""
    rows = _staged_features(inputs).filter("split = 'train'")
    found = boosting.first_splits(rows, FEATURES)
    table = _spark(inputs).createDataFrame([(f, gain) for f, gain, *_ in found], "feature string, gain double")
    return table.withColumn("gain", F.round("gain", 6))


STUMP = {"rounds": 1, "leaves": 2, "learning_rate": 1.0, "stop_early": False}


@query(GAPS)
def gbt_stump(inputs):
    """The scores of all pairs by one tree with one split, and how many pairs have each."""
    rows = _staged_features(inputs)
    forest = model.fit_model(rows.filter("split = 'train'"), **STUMP)
    score = F.round("probability", 9).alias("probability")
    return model.score_pairs(forest, rows).groupBy(score).agg(F.count("*").alias("pairs"))


@query()
def file_matcher(spark, sf_dir):
    """Sources and truth as files, a matcher trained on them, saved, loaded, and its matches
    written to files and read back."""
    raw = DATASETS[GAPS](spark, sf_dir).staged()
    truth, matches, saved = (work_path(spark, name) for name in ("truth", "matches", "matcher"))
    files.write_tsv(truth_lists(raw.normalized().staged(), GAPS), truth, "source1_entity_id")
    paths = _written_sources(raw)
    matcher, _ = linkage.train_from_files(spark, *paths, truth, **STUMP)
    model.save_matcher(matcher, saved)
    linkage.predict_to_files(spark, model.load_matcher(spark, saved), *paths, matches)
    return files.read_truth(spark, matches).fillna("")
