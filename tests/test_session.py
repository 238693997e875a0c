"""The work folder of sessions with and without a shared one."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from kindred import session
from kindred.sources.tables import sources

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
from kindred import session
from kindred.plans.catalog import QUERIES
spark = session.local_session(2, memory="2g", partitions=2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert QUERIES["result_lists"](spark, "/root/testdata/sf0.001").count() > 0
root = session.work_root(spark)
assert session.work_root(spark) == root and session.work_path(spark, "a").startswith(root)
session.use_checkpoints(spark)
assert spark.range(5).checkpoint().count() == 5
"""


def test_a_plain_local_session_runs_queries(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(ROOT)}
    run = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]


def test_the_shared_folder_is_the_clusters(spark, conf):
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    shared = {"spark.checkpoint.dir": "hdfs://store/work/"}
    assert session.work_root(Session(**shared)) == "hdfs://store/work"
    with pytest.raises(ValueError):
        session.work_root(Session(**{"spark.master": "spark://host:7077"}))



def test_staged_records_are_spread_over_files(spark):
    """The smallest table is one row group, which one task scans."""
    records = sources(spark, "/root/testdata/sf0.1", "documents", staged=True).records
    assert len(records.inputFiles()) > 1
    assert records.count() == sources(spark, "/root/testdata/sf0.1", "documents").records.count()
