"""Linkage inputs worked out from the benchmark tables.

No table there holds names, addresses and countries, so two of them are read as
records. Every row and all of its text takes part.

``pages``      one record per web page: title, url, language. The top-level domain
               tells the source.
``documents``  one record per line of a document: its first sentence is the name, the
               rest of the line the address, the language the country. The feed the
               document came from tells the source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.text import normalize_records
from kindred.session import stage

S1_FEEDS = [f"src{i}" for i in range(0, 7)]
S2_FEEDS = [f"src{i}" for i in range(7, 14)]


@dataclass(frozen=True)
class Sources:
    """Records of all sources in one table, tagged by ``source``; ``s1`` is the reference."""

    records: DataFrame

    @property
    def s1(self) -> DataFrame:
        return self.records.filter("source = 's1'")

    @property
    def others(self) -> DataFrame:
        return self.records.filter("source <> 's1'")

    def all(self) -> DataFrame:
        return self.records

    def normalized(self, **options) -> Sources:
        return Sources(normalize_records(self.records, **options))

    def even(self) -> Sources:
        """The same, dealt out by measured sizes: few scan tasks may have read all of it."""
        return Sources(self.records.hint("rebalance"))

    def staged(self) -> Sources:
        """The same, written once: for uses that read the records several times."""
        return Sources(stage(self.records, "records"))


def _tagged(rows: DataFrame) -> DataFrame:
    entity_id = F.concat(F.upper("source"), F.lit("-"), F.col("key"))
    return rows.select(
        entity_id.alias("entity_id"), "business_name", "business_address", "country", "source"
    )


def page_records(spark: SparkSession, sf_dir: str) -> Sources:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    domain = F.regexp_extract("url", r"\.example\.([a-z]+)/", 1)
    rows = pages.select(
        F.lpad(F.col("page_id").cast("string"), 9, "0").alias("key"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("business_name"),
        F.col("url").alias("business_address"),
        F.regexp_extract("html", '<html lang="([a-z]+)', 1).alias("country"),
        F.when(domain == "com", "s1").when(domain == "net", "s2").otherwise("s3").alias("source"),
    )
    return Sources(_tagged(rows))


def gap_records(spark: SparkSession, sf_dir: str) -> Sources:
    """The pages with fields left out: some have no name, address or country, and some an
    address that is a bare number, as the loose and the filling variants meet them."""
    number = F.expr("CAST(substring(entity_id, 4) AS BIGINT)")
    pages = page_records(spark, sf_dir).all()
    return Sources(
        pages.select(
            "entity_id",
            F.when(number % 7 != 0, F.col("business_name")).alias("business_name"),
            F.when(number % 3 == 0, (number % 10).cast("string"))
            .when(number % 11 != 0, F.col("business_address"))
            .alias("business_address"),
            F.when(number % 13 == 0, F.lit("")).otherwise(F.col("country")).alias("country"),
            "source",
        )
    )


def line_records(spark: SparkSession, sf_dir: str) -> Sources:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # A document without a source, or from another one, is in S3.
    tag = F.when(F.col("source").isin(S1_FEEDS), "s1").when(F.col("source").isin(S2_FEEDS), "s2").otherwise("s3")
    split = documents.select(
        "doc_id", "lang", tag.alias("source"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    name = F.regexp_extract("line", "^([^.!?]*)", 1)
    rest = F.regexp_replace("line", "^[^.!?]*[.!?]*", "")
    key = F.concat(
        F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit("-"), F.lpad(F.col("line_no").cast("string"), 5, "0")
    )
    rows = split.select(
        key.alias("key"),
        F.nullif(name, F.lit("")).alias("business_name"),
        F.nullif(rest, F.lit("")).alias("business_address"),
        F.concat(F.lit(" "), F.upper("lang")).alias("country"),
        "source",
    )
    return Sources(_tagged(rows))


DATASETS = {"pages": page_records, "documents": line_records, "gaps": gap_records}


def sources(spark: SparkSession, sf_dir: str, dataset: str, staged: bool = False, **options) -> Sources:
    """Normalised sources of one dataset. If they are to be staged, they are dealt out before
    they are normalised, so that this work and the files are spread, however few tasks scan."""
    raw = DATASETS[dataset](spark, sf_dir)
    if staged:
        return raw.even().normalized(**options).staged()
    return raw.normalized(**options)


def _of(fields: list[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in fields]))


def copy_key(dataset: str) -> Column:
    """What two records share that stand for the same entity: for pages country and title
    (a url is never shared), for lines all fields and their place in the document."""
    if dataset == "documents":
        return F.concat(_of(["country", "name", "address"]), F.expr("right(entity_id, 6)"))
    return _of(["country", "name"])


# Groups of S1 entities of one copy key: what one row of ``listed`` may have to write out.
CHUNKS = 64


def truth_entities(inputs: Sources, dataset: str, *fields: Column) -> DataFrame:
    """``(source1_entity_id, records)``: every S1 entity once, with the copy key and ``fields`` of
    each of its records."""
    record = F.struct(copy_key(dataset).alias("copy_key"), *fields)
    return inputs.s1.groupBy(F.col("entity_id").alias("source1_entity_id")).agg(F.collect_list(record).alias("records"))


def listed(entities: DataFrame, inputs: Sources, dataset: str) -> DataFrame:
    """``truth_entities`` with all their copies in S2 and S3 as ``matched_entity_ids``, in order, a
    comma list that may be empty.

    A list is made once per copy key and meets the S1 entities of its key in chunks, so that what
    is moved grows with the records and not with the pairs; an entity's own list is only written
    out in the task that uses it. Entities with several records have their lists merged.
    """
    copies = inputs.others.groupBy(copy_key(dataset).alias("copy_key")).agg(
        F.array_sort(F.collect_list("entity_id")).alias("ids")
    )
    text = F.coalesce(F.array_join("ids", ","), F.lit("")).alias("matched_entity_ids")
    chunk = F.pmod(F.xxhash64("source1_entity_id"), F.lit(CHUNKS))
    spread = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = (
        entities.filter(F.size("records") == 1)
        .groupBy(F.col("records")[0]["copy_key"].alias("copy_key"), chunk.alias("chunk"))
        .agg(F.collect_list(F.struct("source1_entity_id", "records")).alias("entities"))
        .join(copies, "copy_key", "left")
        .select("copy_key", "chunk", "entities", text)
        # By other columns than they are grouped: where the lists are broadcast, this would else be
        # taken for the same exchange, whose few small rows may all be dealt to one task.
        .repartition(spread, "chunk", "copy_key")
        .select(F.explode("entities").alias("entity"), "matched_entity_ids")
        .select("entity.*", "matched_entity_ids")
    )
    several = (
        entities.filter(F.size("records") > 1)
        .select("source1_entity_id", "records", F.explode("records.copy_key").alias("copy_key"))
        .join(copies, "copy_key", "left")
        .groupBy("source1_entity_id", "records").agg(F.array_sort(F.flatten(F.collect_list("ids"))).alias("ids"))
        .select("source1_entity_id", "records", text)
    )
    return one.unionByName(several)


def truth_lists(inputs: Sources, dataset: str) -> DataFrame:
    """Ground truth in its file form: every S1 entity with all its copies in S2 and S3. Labels and
    true pairs do not need the lists: a pair is true if its keys are equal."""
    return listed(truth_entities(inputs, dataset), inputs, dataset).drop("records")
