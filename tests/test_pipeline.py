"""End to end: relational source over JDBC, zip drops, gold, report, audit."""

import uuid

from pyspark.sql import functions as F

from conftest import SF001, rows_by_name as rows
from quaylake.plans import gold, pipeline, registry, silver
from quaylake.sinks.writers import Lakehouse
from quaylake.sources import driver, files
from quaylake.sources.incremental import Bookmarks

RUN_TS = registry.RUN_TS
RUN_DATE = registry.RUN_DATE
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def seed_source(spark, url):
    for name, df in {
        "Customer": driver.source_customer(spark, SF001),
        "Product": driver.source_product(spark, SF001),
        "Supplier": driver.source_supplier(spark, SF001),
        "Warehouse": driver.source_warehouse(spark, SF001),
    }.items():
        df.write.jdbc(url, name, mode="overwrite", properties=DERBY)


def make_drops(spark, folder):
    files.write_drops(driver.order_lines(spark, SF001), folder, "sales_orders", "csv").count()
    files.write_drops(driver.inventory_snapshots(spark, SF001), folder, "inventory",
                      "json", "array").count()
    files.write_drops(driver.shipment_events(spark, SF001), folder, "shipment",
                      "json", "lines").count()


def test_pipeline_end_to_end(spark, workdir):
    url = f"jdbc:derby:memory:src{uuid.uuid4().hex};create=true"
    seed_source(spark, url)
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    marks = Bookmarks(spark, f"{workdir}/bookmarks")

    first = pipeline.run_dimensions(spark, lake, url, DERBY, marks, RUN_TS, partitions=4)
    assert first["Customer"] == 150 and first["Warehouse"] == 25
    again = pipeline.run_dimensions(spark, lake, url, DERBY, marks, RUN_TS)
    assert set(again.values()) == {0}, "nothing above the bookmarks on the second run"

    make_drops(spark, f"{workdir}/drops")
    metrics = {}
    verdicts = pipeline.run_facts(spark, lake, f"{workdir}/drops", f"{workdir}/land", RUN_TS,
                                  metrics)
    assert {r["status"] for r in verdicts.collect()} == {"valid"}
    quality = metrics["order_lines"]
    assert quality["lines"] == 6000 and 0 < quality["rejected"] < 6000
    pipeline.run_gold(spark, lake, RUN_DATE, RUN_TS, registry.IDLE_RUN_DATE)

    expected = silver.from_driver(spark, SF001, RUN_TS)
    assert rows(lake.table("silver.fact_sales_order")) == rows(expected.fact_sales_order)
    assert rows(lake.table("silver.fact_shipments")) == rows(expected.fact_shipments)
    assert rows(lake.table("silver.fact_inventory")) == rows(expected.fact_inventory)
    assert rows(lake.table("gold.fact_sales_summary")) == rows(gold.sales_summary(expected))
    assert rows(lake.table("gold.fact_supply_chain_summary")) == rows(
        gold.supply_chain_summary(expected))
    late = lake.table("gold.late_deliveries_daily")
    assert rows(late) == rows(gold.late_deliveries(expected, RUN_DATE))

    # Re-running facts and gold with the same inputs changes nothing.
    tables = [*pipeline.AUDIT_TABLES, "silver.order_rejects", pipeline.PROCESSED]
    before = {t: rows(lake.table(t)) for t in tables}
    assert pipeline.run_facts(spark, lake, f"{workdir}/drops", f"{workdir}/land", RUN_TS).count() == 0, (
        "no archive is new")
    pipeline.run_gold(spark, lake, RUN_DATE, RUN_TS, registry.IDLE_RUN_DATE)
    assert before == {t: rows(lake.table(t)) for t in tables}
    # A run that broke off before it marked its archives is repeated whole.
    lake.replace(pipeline.PROCESSED, lake.table(pipeline.PROCESSED).limit(0))
    pipeline.run_facts(spark, lake, f"{workdir}/drops", f"{workdir}/land", RUN_TS)
    assert before == {t: rows(lake.table(t)) for t in tables}

    report = pipeline.supplier_report(lake).collect()
    assert len(report) == 10
    counts = {r["table_name"]: r["row_count"] for r in pipeline.audit(lake).collect()}
    assert counts["silver.dim_warehouse"] == 25
    assert counts["gold.fact_supply_chain_summary"] == lake.table(
        "silver.fact_sales_order").select("salesordernumber").distinct().count()
    assert "mart.fact_sales_order" in lake.list_tables("mart")
    assert lake.table("silver.order_rejects").where(
        F.col("error_description") == "Invalid date order").count() > 0
