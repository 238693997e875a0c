"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Every limit below is compared by Spark with measured sizes: a side is broadcast,
# or a sort-merge join turned into a hash join, only when it is known to fit.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", memory: str = "16g", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kindred")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Folders made for local sessions without a shared one, by application.
_own_folders: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The folder the cluster shares among its executors, from ``spark.checkpoint.dir``.

    A private folder is made only for a local master, where driver and executors are
    one process. On a cluster an unset folder is an error: a machine-local path would
    lose its files with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="kindred-")
    return _own_folders[application]


def use_checkpoints(spark: SparkSession) -> None:
    """Let ``checkpoint()`` write to the shared folder, unless the caller has set another."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_root(spark))


def work_path(spark: SparkSession, name: str) -> str:
    """A path not used before, for one staged table or file set."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """What is written within leaves no shuffle files behind: Spark removes those of a write
    when it ends, instead of when the driver happens to collect its garbage. What has been
    written does not need them, so a chain of writes takes the disk of its largest step."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def stage(df, name: str, partition_by: str | None = None):
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage, survives lost executors, and gives the planner
    real sizes for the joins that follow. A filter on ``partition_by`` then reads only
    the files it needs. Shuffles it took to make the table are freed.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with shuffles_freed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
