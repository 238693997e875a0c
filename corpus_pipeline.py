"""From raw documents to packed sequences, each stage written before the next reads it.

1. toxicity         texts that the classifier rejects go
2. near_duplicates  one document of each group of near copies stays (five words, 0.8)
3. decontamination  documents that hold a benchmark item go
4. secret_scans     secrets are replaced in the texts; every document stays
5. packing          the documents as pieces of sequences of 4096 tokens

The first four return the columns of ``documents``. SQL can express neither the classifier
nor packing, so there is no SQL for the whole; the tests hold it against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import common, decontaminate, near_dup, packing, secret_scan, toxicity
from kindred.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, common.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs, size=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scans", replace_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = common.table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
