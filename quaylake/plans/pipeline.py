"""The three jobs and the report, in the order the workflow runs them:

1. `run_dimensions`  relational sources -> bronze copies -> silver dimensions
2. `run_facts`       file drops -> checks -> landing -> silver facts -> mart
3. `run_gold`        silver -> gold summaries and daily reports -> mart
4. `supplier_report` / `audit`

Every step writes through `Lakehouse`, so each job reads its inputs from
tables on shared storage: a failed job is re-run from its inputs, and all
writes are keyed or partition-replacing, so re-running is harmless.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dedup import keep_one
from ..sinks.writers import Lakehouse
from ..sources import files
from ..sources.incremental import (JDBC_PARTITIONS, OVERLAP, SOURCES, Bookmarks, overlapped,
                                   read_jdbc, unseen)
from . import gold, refresh, silver
from .refresh import GOLD_MERGES  # noqa: F401

DAILY_REPORTS = {
    "gold.late_deliveries_daily": lambda s, d: gold.late_deliveries(s, d),
    "gold.inventory_overstock_inactive": lambda s, d: gold.overstock_inactive(s, d),
    "gold.high_shipping_orders": lambda s, d: gold.high_shipping_orders(s, d),
    "gold.order_stock_shortage": lambda s, d: gold.order_stock_shortage(s, d),
    "gold.supplier_delivery_performance": lambda s, d: gold.supplier_delivery_performance(s, d),
    "gold.upcoming_stock_shortage": lambda s, d: gold.upcoming_stock_shortage(s, d),
    "gold.sales_order_lead_time": lambda s, d: gold.order_lead_time(s, d),
}
PROCESSED = "bronze.processed_files"
AUDIT_TABLES = [
    "silver.dim_customer", "silver.dim_product", "silver.dim_supplier", "silver.dim_warehouse",
    "silver.fact_inventory", "silver.fact_sales_order", "silver.fact_shipments",
    "gold.fact_sales_summary", "gold.fact_sales_summary_by_country",
    "gold.fact_sales_summary_by_supplier_daily", "gold.fact_sales_summary_by_supplier_monthly",
    "gold.fact_supply_chain_summary", "gold.high_shipping_orders",
    "gold.inventory_overstock_inactive", "gold.late_deliveries_daily",
    "gold.order_stock_shortage", "gold.sales_order_lead_time",
    "gold.supplier_delivery_performance",
]


def _now(run_ts):
    return silver.ts_literal(run_ts)


# --- 1. dimensions --------------------------------------------------------------

def run_dimensions(spark: SparkSession, lake: Lakehouse, url: str, properties: dict,
                   bookmarks: Bookmarks, run_ts, sources=SOURCES,
                   partitions: int = JDBC_PARTITIONS, overlap=OVERLAP) -> dict[str, int]:
    """Incremental load of each relational source; returns new rows per source.
    Each source is read with `partitions` parallel range queries, from `overlap` behind its
    mark; rows that the bronze table holds with the same time are known."""
    lake.create_all()
    read = {}
    for src in sources:
        start = overlapped(bookmarks.get(src.name), overlap)
        found = read_jdbc(spark, url, src.name, src.ts_col, start, properties, partitions)
        increment = lake.stage(unseen(found, lake.table(src.target), src.key, src.ts_col, start),
                               f"src-{src.name}")
        if increment.isEmpty():
            read[src.name] = 0
            continue
        latest = keep_one(increment, [src.key], [f"{src.ts_col} DESC"])
        lake.merge(src.target, latest, [src.key], check_duplicates=False)
        _load_dimension(lake, src.name, increment, run_ts)
        bookmarks.advance(src.name, increment, src.ts_col, run_ts)
        read[src.name] = increment.count()
    return read


def _load_dimension(lake: Lakehouse, name: str, increment: DataFrame, run_ts) -> None:
    now = _now(run_ts)
    stamps = {"created_at": now, "updated_at": now}
    if name == "Customer":
        dim = silver.transform_customer(increment, run_ts)
        lake.merge_scd2("silver.dim_customer", dim, "customer_id", silver.CUSTOMER_COMPARE, run_ts)
    elif name == "Supplier":
        dim = silver.transform_supplier(increment, run_ts)
        lake.merge_scd2("silver.dim_supplier", dim, "supplier_id", silver.SUPPLIER_COMPARE, run_ts)
    elif name == "Product":
        dim = silver.transform_product(increment, run_ts)
        lake.merge("silver.dim_product", dim, ["product_id"],
                   update_cols=[c for c in dim.columns if c != "created_at"],
                   update_exprs={"updated_at": now}, insert_exprs=stamps,
                   check_duplicates=False)
    elif name == "Warehouse":
        dim = silver.transform_warehouse(increment, run_ts)
        lake.merge("silver.dim_warehouse", dim, ["warehouse_id"],
                   update_cols=[c for c in dim.columns if c != "created_at"],
                   update_exprs={"updated_at": now}, insert_exprs=stamps,
                   check_duplicates=False)
    else:
        raise ValueError(f"no dimension is loaded from {name}")
    table = f"dim_{name.lower()}"
    refresh.note(lake, table, refresh.DIMENSION_KEYS[table], dim)


# --- 2. facts ---------------------------------------------------------------------

def run_facts(spark: SparkSession, lake: Lakehouse, drops: str, landing_root: str,
              run_ts, metrics: dict | None = None, workers: int = 3) -> DataFrame:
    """Check and land the new drops, load the three silver facts, publish them.

    Only archives that no earlier run finished are read (bronze.processed_files; an archive
    that changed counts as new).  Returns the member verdicts (accepted, rejected, skipped).
    A kind with no accepted member is skipped.  Invalid order lines are kept in
    silver.order_rejects, in one partition for each set of archives, which a repeated run
    over the same set replaces.  If a `metrics` dict is given, it receives the order-line
    counts ("order_lines": {"lines", "rejected"}).
    """
    lake.create_all()
    lake.create_table(PROCESSED, "path string, modificationTime timestamp, length bigint, run_ts timestamp", [])
    mark = ["path", "modificationTime", "length"]
    new = lake.stage(files.archives(spark, drops).join(lake.table(PROCESSED), mark, "left_anti"), "new-archives")
    paths = sorted(r["path"] for r in new.select("path").collect())     # names, as in any listing
    batch = hashlib.sha256("\n".join(paths).encode()).hexdigest()[:16]
    lines = files.extract_archives(spark, paths)
    if paths:
        load_drop_lines(spark, lake, lines, landing_root, run_ts, batch, metrics, workers)
        lake.append(PROCESSED, new.withColumn("run_ts", _now(run_ts)))      # last: all is written
    return files.member_verdicts(lines)


def load_drop_lines(spark: SparkSession, lake: Lakehouse, lines: DataFrame, landing_root: str,
                    run_ts, batch: str, metrics: dict | None = None, workers: int = 3) -> None:
    """Land the member lines of some archives and load what was accepted; `batch` names
    the set of archives, and a repeated run over it replaces what it wrote."""
    metrics = {} if metrics is None else metrics
    files.land(lines, landing_root, run_ts, batch)
    stamp = spark.range(1).select(
        F.date_format(_now(run_ts), "yyyy-MM-dd").alias("d"),
        F.date_format(_now(run_ts), "HH").alias("h")).first()
    accepted = lines.where(F.col("status") == files.VALID)
    present = accepted.select("kind", "layout").distinct().collect()   # at most 9 rows
    kinds = {r["kind"] for r in present}

    def load_orders():
        # Valid / rejected line counts are gathered while the flagged rows are
        # staged (one job, no separate count actions).
        quality = Observation("order_quality")
        flagged = lake.stage(silver.flag_orders(files.parse_orders_lines(
            accepted.where(F.col("kind") == "sales_orders"))).observe(
                quality,
                F.count(F.lit(1)).alias("lines"),
                F.sum(F.col("error_flag")).alias("rejected")), "orders-flagged")
        metrics["order_lines"] = quality.get
        rejects = (silver.rejected_orders(flagged).withColumn("run_ts", _now(run_ts))
                   .withColumn("batch", F.lit(batch)))
        if not lake.exists("silver.order_rejects"):
            ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rejects.schema)
            lake.create_table("silver.order_rejects", ddl, ["batch"])
        lake.replace("silver.order_rejects", rejects)
        fact = lake.stage(silver.fact_sales_order(silver.valid_orders(flagged)), "orders-fact")
        lake.merge("silver.fact_sales_order", fact, silver.ORDER_KEYS, staged=True, check_duplicates=False)
        refresh.note(lake, refresh.ORDERS, "createddate", silver.valid_orders(flagged))
        lake.publish_upsert("mart.fact_sales_order", fact, silver.ORDER_KEYS, staged=True)

    def landed_json(kind, ddl):
        layouts = {r["layout"] for r in present if r["kind"] == kind}
        return files.read_landed_json(spark, files.landed(landing_root, kind), ddl, layouts,
                                      stamp["d"], stamp["h"], batch)

    def load_inventory():
        raw = landed_json("inventory", schemas.INVENTORY_JSON)
        inv = lake.stage(silver.fact_inventory(raw), "inventory-fact")
        lake.merge("silver.fact_inventory", inv, silver.INVENTORY_KEYS, staged=True, check_duplicates=False)
        lake.publish_upsert("mart.fact_inventory", inv.withColumn(
            "last_movement_date", F.try_to_date("last_movement_date")), silver.INVENTORY_KEYS, staged=True)

    def load_shipments():
        raw = landed_json("shipment", schemas.SHIPMENT_JSON)
        # Read and reduced once for both tables.
        ship = lake.stage(silver.fact_shipments(raw), "shipments-fact")
        lake.merge("silver.fact_shipments", ship, silver.SHIPMENT_KEYS, staged=True, check_duplicates=False)
        lake.publish_upsert("mart.fact_shipments", ship.withColumn(
            "promised_delivery_date", F.try_to_date("promised_delivery_date")),
            silver.SHIPMENT_KEYS, staged=True)

    # The three facts are independent: loaded as concurrent jobs, each only if
    # its kind arrived.  Then the dimensions are copied to the mart.
    loaders = {"sales_orders": load_orders, "inventory": load_inventory,
               "shipment": load_shipments}
    _run_all([load for kind, load in loaders.items() if kind in kinds], workers)
    _run_all([lambda d=dim: lake.publish_snapshot(f"mart.{d}", lake.table(f"silver.{d}"))
              for dim in ("dim_customer", "dim_product", "dim_supplier", "dim_warehouse")],
             workers)


# --- 3. gold ----------------------------------------------------------------------

def silver_tables(lake: Lakehouse) -> silver.Silver:
    return silver.Silver(**{n: lake.table(f"silver.{n}") for n in (
        "fact_sales_order", "fact_inventory", "fact_shipments",
        "dim_customer", "dim_product", "dim_supplier", "dim_warehouse")})


def run_gold(spark: SparkSession, lake: Lakehouse, run_date, run_ts,
             idle_run_date=None, workers: int = 4, full: bool = False) -> None:
    """All gold tables for one run; reports are reloaded for `run_date`, the sales summaries
    recomputed where the loads since the last run changed rows (`full`: everywhere).
    The tables are independent and written by `workers` concurrent jobs."""
    lake.create_all()
    s = silver_tables(lake)
    sales = refresh.Refresh(lake, s, run_date, run_ts, full=full)
    tasks = list(sales.merges)
    tasks.append(lambda: lake.merge("gold.fact_supply_chain_summary", gold.supply_chain_summary(s),
                                    ["salesordernumber"], check_duplicates=False))
    tasks.append(lambda: lake.rebuild("gold.fact_shipping_performance",
                                      gold.shipping_performance(s)))
    tasks.append(lambda: lake.rebuild("gold.aggregated_inventory_levels", gold.inventory_levels(s)))

    def report(table, build):
        day = idle_run_date if (idle_run_date and "overstock" in table) else run_date
        rows = lake.stage(build(s, day), table.replace(".", "_"))
        lake.reload_day(table, rows, day)
        lake.publish_snapshot("mart." + table.split(".")[1], rows)

    for table, build in DAILY_REPORTS.items():
        tasks.append(lambda t=table, b=build: report(t, b))
    _run_all(tasks, workers)
    sales.done()


def _run_all(tasks, workers: int) -> None:
    """Run independent table writes as concurrent Spark jobs; re-raise the
    first failure (every write is idempotent, so a re-run repairs the rest)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        for future in [pool.submit(t) for t in tasks]:
            future.result()


# --- 4. report and audit ------------------------------------------------------------

def supplier_report(lake: Lakehouse, n: int = 10) -> DataFrame:
    return gold.top_supplier_sales(lake.table("gold.fact_sales_summary_by_supplier_daily"), n)


def audit(lake: Lakehouse, tables: list[str] | None = None) -> DataFrame:
    from ..sinks.writers import row_counts
    return row_counts(lake, tables or AUDIT_TABLES)
