"""Plan shapes the scale design relies on (checked with explain())."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import SF001
from quaylake.operators.dedup import keep_one
from quaylake.operators.merge import upsert
from quaylake.plans import gold, registry


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_keep_one_limits_rows_per_key_before_the_shuffle(spark, workdir):
    # One key holds a third of the rows.
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    rows.write.parquet(f"{workdir}/skew")
    df = spark.read.parquet(f"{workdir}/skew")
    text = plan(keep_one(df, ["k"], ["v DESC"]))
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle, "partial top-1 runs map-side"
    assert text.count("WindowGroupLimit") == 2
    assert keep_one(df, ["k"], ["v DESC"]).where("k = 0").first()["v"] == 29997


def test_upsert_shuffles_each_side_once(spark, workdir):
    spark.range(100).selectExpr("id as k", "id as v").write.parquet(f"{workdir}/t")
    spark.range(50, 150).selectExpr("id as k", "id as v").write.parquet(f"{workdir}/s")
    t, s = spark.read.parquet(f"{workdir}/t"), spark.read.parquet(f"{workdir}/s")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(t, s, ["k"])
        assert merged.count() == 150
        merged.collect()
        final = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "FullOuter" in final
    assert final.count("Exchange hashpartitioning") == 2, final
    # Twice each: the rows to join, and those with a NULL key (skipped by file statistics).
    assert final.count("FileScan parquet") == 4


def test_report_filters_reach_the_scan(spark, workdir):
    s = registry._staged_silver(spark, SF001, names=["fact_sales_order", "fact_inventory"])
    text = plan(gold.upcoming_stock_shortage(s, registry.RUN_DATE), "formatted")
    assert "GreaterThanOrEqual(createddate,1998-09-02)" in text
    assert "ReadSchema: struct<createddate:date,quantity:int,product_id:int>" in text


def test_building_reports_runs_no_job(spark):
    s = registry._staged_silver(spark, SF001)
    spark.sparkContext.setJobGroup("build-only", "reports are plans")
    try:
        registry.gold_tables(s)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_dimensions_are_broadcast_from_measured_size(spark):
    s = registry._staged_silver(spark, SF001)
    df = gold.sales_summary(s)
    df.collect()
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()
