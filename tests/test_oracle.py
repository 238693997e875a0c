"""Every query with SQL against DuckDB on the smallest tables."""

import pytest

import check_oracle
from __spark_entry__ import entry
from kindred.plans.catalog import QUERIES
from kindred.plans.oracle import ORACLE

SF_DIR = f"{check_oracle.DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check_oracle.duck_connection(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    message, rows, _, _ = check_oracle.compare(spark, duck, SF_DIR, name, ORACLE[name])
    assert message is None
    assert rows > 0


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["source1_entity_id", "matched_entity_ids"]
    assert frame.count() > 0


def test_rows_that_can_fail(duck):
    """At a low cap some true pairs are lost and some entities find a part of theirs; the
    variants of an operator differ on the data they are tried on."""
    larger = check_oracle.duck_connection(f"{check_oracle.DATA}/sf0.01")
    figures = larger.execute(ORACLE["blocking_metrics_cap3"])
    row = dict(zip([d[0] for d in figures.description], figures.fetchone()))
    assert row["found_pairs"] < row["true_pairs"]
    assert row["entities_all_found"] < row["entities_any_found"] < row["entities_with_truth"]
    for one, other in (
        ("candidate_pairs_gaps", "candidate_pairs_unguarded"), ("pair_features_gaps", "pair_features_filled"),
    ):
        assert sorted(map(str, larger.execute(ORACLE[one]).fetchall())) != sorted(
            map(str, larger.execute(ORACLE[other]).fetchall())
        )
