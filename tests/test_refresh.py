"""Refresh of the sales summaries by changed groups; counts without column reads."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quaylake import schemas
from quaylake.plans import pipeline, refresh, silver
from quaylake.sinks.writers import Lakehouse

ORDER = ("salesordernumber string, createddate string, customer_id int, product_id int, "
         "supplier_id string, quantity int")
FIRST_TS, SECOND_TS = "2024-02-01 00:00:00", "2024-02-02 00:00:00"
FIRST = [("o1", "2024-01-01", 1, 1, "s1", 2), ("o2", "2024-01-01", 2, 1, "s2", 3),
         ("o3", "2024-01-02", 1, 1, "s1", 5), ("o4", "2024-02-01", 3, 1, "s1", 7),
         ("o5", "2024-02-01", 9, 1, "s3", 1), ("o9", "2024-02-01", 4, 1, "s1", 1)]


def filled(spark, schema, given):
    """Rows with the given columns and NULLs elsewhere, in the table's schema."""
    wanted = spark.createDataFrame([], schema).schema
    return given.select(*[(F.col(f.name) if f.name in given.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in wanted])


@pytest.fixture()
def lake(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_", buckets=4)
    for name in [*refresh.GOLD_MERGES, *(n for n in schemas.TABLES if n.startswith("silver."))]:
        lake.create_table(name, schemas.TABLES[name])
    for name, ddl, dim in [
            ("dim_customer", "customer_id int, customer_name string, country string, is_current boolean",
             [(1, "A", "DE", True), (2, "B", "FR", True), (3, "C", None, True), (4, "D", "ES", True)]),
            ("dim_product", "product_id int, product_name string", [(1, "P")]),
            ("dim_supplier", "supplier_id string, supplier_name string, is_current boolean",
             [("s1", "S1", True), ("s2", "S2", True)]),
            ("dim_warehouse", "warehouse_id string, warehouse_name string", [("w1", "W")])]:
        lake.replace(f"silver.{name}", filled(spark, schemas.TABLES[f"silver.{name}"],
                                              spark.createDataFrame(dim, ddl)))
    return lake


def load_orders(spark, lake, given):
    fact = filled(spark, schemas.FACT_SALES_ORDER, spark.createDataFrame(given, ORDER)
                  .withColumn("unitprice", F.lit(1.5)).withColumn("taxamount", F.lit(0.5)))
    lake.merge("silver.fact_sales_order", fact, silver.ORDER_KEYS)
    refresh.note(lake, refresh.ORDERS, "createddate", fact)


def run(lake, ts, full=False):
    done = refresh.Refresh(lake, pipeline.silver_tables(lake), "2024-02-01", ts, full=full)
    for merge in done.merges:
        merge()
    done.done()
    return len(done.merges)


def measures(lake):
    return {t: rows(lake.table(t).drop("last_updated")) for t in refresh.GOLD_MERGES}


def days_at(lake, ts):
    daily = lake.table("gold.fact_sales_summary_by_supplier_daily")
    return {str(r[0]) for r in daily.where(F.col("last_updated") == F.lit(ts).cast("timestamp"))
            .select("sales_date").distinct().collect()}


def test_one_day_load_touches_its_groups_alone(spark, lake):
    load_orders(spark, lake, FIRST)
    assert run(lake, FIRST_TS) == 4 and days_at(lake, FIRST_TS) == {"2024-01-01", "2024-01-02", "2024-02-01"}
    assert run(lake, SECOND_TS) == 0, "nothing changed since"
    # One row changes its quantity and supplier, one is new, both on one day.
    load_orders(spark, lake, [("o2", "2024-01-01", 2, 1, "s1", 4), ("o6", "2024-01-01", 3, 1, "s2", 6)])
    run(lake, SECOND_TS)
    assert days_at(lake, SECOND_TS) == {"2024-01-01"}
    countries = {r["country"]: str(r["last_updated"]) for r in
                 lake.table("gold.fact_sales_summary_by_country").collect()}
    assert countries == {"DE": SECOND_TS, "FR": SECOND_TS, None: SECOND_TS, "ES": FIRST_TS}, (
        "countries that bought on the changed day")
    months = {r["sales_month"]: str(r["last_updated"]) for r in
              lake.table("gold.fact_sales_summary_by_supplier_monthly").collect()}
    assert months == {"2024-01": SECOND_TS, "2024-02": FIRST_TS}
    refreshed = measures(lake)
    run(lake, "2024-02-03 00:00:00", full=True)
    assert measures(lake) == refreshed, "equal to the merge of the whole reports"


def test_changed_dimension_rows_touch_the_days_that_show_them(spark, lake):
    load_orders(spark, lake, FIRST)
    run(lake, FIRST_TS)
    moved = lake.table("silver.dim_customer").withColumn(
        "country", F.when(F.col("customer_id") == 2, F.lit("IT")).otherwise(F.col("country")))
    old = lake.table("silver.dim_customer").where("customer_id = 2").withColumn("is_current", F.lit(False))
    lake.replace("silver.dim_customer", lake.stage(moved.union(old)))
    refresh.note(lake, "dim_customer", "customer_id", spark.createDataFrame([(2,)], "customer_id int"))
    run(lake, SECOND_TS)
    assert days_at(lake, SECOND_TS) == {"2024-01-01"}
    countries = {r["country"]: str(r["last_updated"]) for r in
                 lake.table("gold.fact_sales_summary_by_country").collect()}
    assert countries["IT"] == SECOND_TS and countries["DE"] == FIRST_TS
    refreshed = measures(lake)
    run(lake, "2024-02-03 00:00:00", full=True)
    assert measures(lake) == refreshed


def test_scan_is_pruned_to_the_days(spark, lake):
    load_orders(spark, lake, FIRST)
    run(lake, FIRST_TS)
    load_orders(spark, lake, [("o7", "2024-01-02", 2, 1, "s1", 4)])
    changes = lake.table(refresh.CHANGES).join(lake.table(refresh.TAKEN), "entry", "left_anti")
    reports = refresh.touched_reports(pipeline.silver_tables(lake), changes, "2024-02-01", SECOND_TS)
    for table in ("gold.fact_sales_summary", "gold.fact_sales_summary_by_supplier_daily"):
        plan = reports[table]._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line and "salesordernumber" in line
                    or "FileScan" in line and "quantity" in line)
        assert "PartitionFilters: [" in scan and "createddate" in scan.split("PartitionFilters: [")[1].split("]")[0]
        assert "2024-01-02" in scan or "19724" in scan


def test_interrupted_refresh_is_repeated(spark, lake):
    load_orders(spark, lake, FIRST)
    run(lake, FIRST_TS)
    load_orders(spark, lake, [("o8", "2024-01-02", 3, 1, "s1", 4)])
    broken = refresh.Refresh(lake, pipeline.silver_tables(lake), "2024-02-01", SECOND_TS)
    broken.merges[0]()                  # ends before the other merges
    assert run(lake, SECOND_TS) == 4 and days_at(lake, SECOND_TS) == {"2024-01-02"}


def test_audit_reads_no_column(spark, lake):
    load_orders(spark, lake, FIRST)
    counts = pipeline.audit(lake, ["silver.fact_sales_order", "silver.dim_customer", "gold.fact_sales_summary"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("ReadSchema: struct<>" in s for s in scans)
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {
        "silver.fact_sales_order": 6, "silver.dim_customer": 4, "gold.fact_sales_summary": 0}
