"""The saved matcher: what the query states of it, and that rows are read once for both scores."""

from pyspark.sql import functions as F

from kindred.plans import catalog
from kindred.plans.oracle import ORACLE


def test_roundtrip_states_all_it_did_and_moves_pairs_once(spark, tmp_path):
    html = F.concat(F.lit('<html lang="en"><title>firm '), F.col("id") % 40, F.lit(" of name"), F.col("id") % 9, F.lit("</title>"))
    tld = F.element_at(F.array(F.lit("com"), F.lit("net"), F.lit("org")), (F.col("id") % 3 + 1).cast("int"))
    url = F.concat(F.lit("http://a.example."), tld, F.lit("/"), F.col("id"))
    spark.range(600).select(F.col("id").alias("page_id"), url.alias("url"), html.alias("html")).write.parquet(f"{tmp_path}/pages.parquet")
    found = catalog.QUERIES["gbt_roundtrip"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    row = found.first()
    assert row.pairs > 0 and row.equal_scores == row.pairs and row.accepted_without_score == 0
    assert row.threshold_kept and row.features_kept and row.forest_kept
    assert all(column in ORACLE["gbt_roundtrip"] for column in found.columns)
