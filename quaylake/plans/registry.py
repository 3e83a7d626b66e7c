"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the driver's tables; the silver tables are derived from them on
the fly (see `silver.from_driver`), so every query's work grows with them.
Clock values are fixed so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dedup import keep_one
from ..operators.merge import scd2, upsert
from ..session import scratch_path, tune
from ..sinks.writers import MART_TABLES, Lakehouse
from ..sources import driver, files, incremental
from . import gold, refresh, silver

RUN_DATE = "1998-09-02"
RUN_TS = "1998-09-02 00:00:00"
IDLE_RUN_DATE = "2001-11-15"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


def _silver(spark: SparkSession, sf_dir: str, columns: dict[str, list[str]] | None = None) -> silver.Silver:
    return silver.from_driver(spark, sf_dir, RUN_TS, columns)


# --- gold -------------------------------------------------------------------

@query("sales_summary")
def _sales_summary(spark, sf_dir):
    return gold.sales_summary(_silver(spark, sf_dir))


@query("sales_by_country")
def _sales_by_country(spark, sf_dir):
    return gold.sales_by_country(_silver(spark, sf_dir), RUN_TS)


@query("sales_by_supplier_daily")
def _sales_by_supplier_daily(spark, sf_dir):
    return gold.sales_by_supplier_daily(_silver(spark, sf_dir), RUN_TS)


@query("sales_by_supplier_monthly")
def _sales_by_supplier_monthly(spark, sf_dir):
    return gold.sales_by_supplier_monthly(_silver(spark, sf_dir), RUN_TS)


@query("supply_chain_summary")
def _supply_chain_summary(spark, sf_dir):
    return gold.supply_chain_summary(_silver(spark, sf_dir, gold.SUPPLY_CHAIN_FACTS))


@query("shipping_performance")
def _shipping_performance(spark, sf_dir):
    return gold.shipping_performance(_silver(spark, sf_dir))


@query("inventory_levels")
def _inventory_levels(spark, sf_dir):
    return gold.inventory_levels(_silver(spark, sf_dir))


@query("late_deliveries")
def _late_deliveries(spark, sf_dir):
    return gold.late_deliveries(_silver(spark, sf_dir), RUN_DATE)


@query("overstock_inactive")
def _overstock_inactive(spark, sf_dir):
    return gold.overstock_inactive(_silver(spark, sf_dir), IDLE_RUN_DATE)


@query("high_shipping_orders")
def _high_shipping_orders(spark, sf_dir):
    return gold.high_shipping_orders(_silver(spark, sf_dir), RUN_DATE)


@query("order_stock_shortage")
def _order_stock_shortage(spark, sf_dir):
    return gold.order_stock_shortage(_silver(spark, sf_dir), RUN_DATE)


@query("supplier_delivery_performance")
def _supplier_delivery_performance(spark, sf_dir):
    return gold.supplier_delivery_performance(_silver(spark, sf_dir), RUN_DATE)


@query("upcoming_stock_shortage")
def _upcoming_stock_shortage(spark, sf_dir):
    return gold.upcoming_stock_shortage(_silver(spark, sf_dir), RUN_DATE)


@query("order_lead_time")
def _order_lead_time(spark, sf_dir):
    return gold.order_lead_time(_silver(spark, sf_dir), RUN_DATE)


def _many_warehouses(spark, sf_dir, columns=None):
    """Silver where products lie in several warehouses."""
    return silver.Silver(**{**_silver(spark, sf_dir, columns).tables(), "fact_inventory": silver.fact_inventory(
        driver.warehouse_stock(spark, sf_dir), (columns or {}).get("fact_inventory"))})


@query("supply_chain_summary_warehouses")
def _supply_chain_summary_warehouses(spark, sf_dir):
    return gold.supply_chain_summary(_many_warehouses(spark, sf_dir, gold.SUPPLY_CHAIN_FACTS))


@query("order_stock_shortage_warehouses")
def _order_stock_shortage_warehouses(spark, sf_dir):
    return gold.order_stock_shortage(_many_warehouses(spark, sf_dir), RUN_DATE)


@query("upcoming_stock_shortage_warehouses")
def _upcoming_stock_shortage_warehouses(spark, sf_dir):
    return gold.upcoming_stock_shortage(_many_warehouses(spark, sf_dir), RUN_DATE)


@query("inventory_levels_warehouses")
def _inventory_levels_warehouses(spark, sf_dir):
    return gold.inventory_levels(_many_warehouses(spark, sf_dir))


@query("top_supplier_sales")
def _top_supplier_sales(spark, sf_dir):
    return gold.top_supplier_sales(gold.sales_by_supplier_daily(_silver(spark, sf_dir), RUN_TS))


# --- silver: quality, de-duplication, dimensions -----------------------------


# A first load ran at LOAD_TS and saw everything before LOAD_CUTOFF; the
# second load at RUN_TS reads what changed since (with an overlap window for
# the order feed, whose late lines arrive up to half a year after).
LOAD_CUTOFF = "1998-01-01"
LOAD_TS = "1998-01-01 00:00:00"
OVERLAP_FROM = "1997-07-01"


def _flagged(spark, sf_dir):
    return silver.flag_orders(driver.order_lines(spark, sf_dir))


@query("order_quality_flags")
def _order_quality_flags(spark, sf_dir):
    return _flagged(spark, sf_dir)


@query("order_valid")
def _order_valid(spark, sf_dir):
    return silver.valid_orders(_flagged(spark, sf_dir))


@query("order_rejects")
def _order_rejects(spark, sf_dir):
    return silver.rejected_orders(_flagged(spark, sf_dir))


@query("order_quality_defects")
def _order_quality_defects(spark, sf_dir):
    """The rules on a feed where each of them fires; dates arrive as text."""
    return silver.flag_orders(driver.defective_order_lines(spark, sf_dir))


@query("dedup_orders")
def _dedup_orders(spark, sf_dir):
    return silver.fact_sales_order(silver.valid_orders(_flagged(spark, sf_dir)))


@query("dedup_inventory")
def _dedup_inventory(spark, sf_dir):
    return silver.fact_inventory(driver.inventory_movements(spark, sf_dir))


@query("dedup_warehouse_stock")
def _dedup_warehouse_stock(spark, sf_dir):
    """Stock of products in several warehouses each; times arrive as text."""
    return silver.fact_inventory(driver.warehouse_stock(spark, sf_dir))


@query("dedup_shipments")
def _dedup_shipments(spark, sf_dir):
    return silver.fact_shipments(driver.shipment_events(spark, sf_dir))


@query("dedup_customers")
def _dedup_customers(spark, sf_dir):
    return keep_one(driver.customer_changes(spark, sf_dir), ["CustomerID"], ["UpdatedAt DESC"])


@query("dedup_suppliers")
def _dedup_suppliers(spark, sf_dir):
    return keep_one(driver.supplier_changes(spark, sf_dir), ["SupplierID"], ["UpdatedAt DESC"])


@query("dedup_warehouses")
def _dedup_warehouses(spark, sf_dir):
    return keep_one(driver.warehouse_changes(spark, sf_dir), ["WarehouseID"], ["UpdatedAt DESC"])


@query("dim_customer")
def _dim_customer(spark, sf_dir):
    return silver.transform_customer(driver.customer_changes(spark, sf_dir), RUN_TS)


@query("dim_product")
def _dim_product(spark, sf_dir):
    return silver.transform_product(driver.source_product(spark, sf_dir), RUN_TS)


@query("dim_supplier")
def _dim_supplier(spark, sf_dir):
    return silver.transform_supplier(driver.supplier_changes(spark, sf_dir), RUN_TS)


@query("dim_warehouse")
def _dim_warehouse(spark, sf_dir):
    return silver.transform_warehouse(driver.warehouse_changes(spark, sf_dir), RUN_TS)


# --- upserts -------------------------------------------------------------------

def _since(df, col, start):
    return df.where(F.col(col) >= F.lit(start).cast(df.schema[col].dataType))


def _before(df, col, end):
    return df.where(F.col(col) < F.lit(end).cast(df.schema[col].dataType))


@query("upsert_one_key")
def _upsert_one_key(spark, sf_dir):
    """Bronze customer copy: state after the first load, upserted with the
    records touched since."""
    target = driver.customer_snapshot(spark, sf_dir, LOAD_CUTOFF).drop("order_count")
    changes = _since(driver.customer_snapshot(spark, sf_dir).drop("order_count"),
                     "UpdatedAt", LOAD_CUTOFF)
    return upsert(target, changes, ["CustomerID"])


@query("upsert_order_keys")
def _upsert_order_keys(spark, sf_dir):
    """Order fact: first load had no tax figures yet; the second load
    re-reads the overlap window with taxes and adds the new days."""
    fact = silver.fact_sales_order(silver.valid_orders(_flagged(spark, sf_dir)))
    target = _before(fact, "createddate", LOAD_CUTOFF).withColumn(
        "taxamount", F.lit(0).cast("decimal(7,4)"))
    source = _since(fact, "createddate", OVERLAP_FROM)
    return upsert(target, source, silver.ORDER_KEYS)


@query("upsert_inventory_keys")
def _upsert_inventory_keys(spark, sf_dir):
    """Stock table after the first load, upserted with later movements."""
    moves = driver.inventory_movements(spark, sf_dir)
    target = silver.fact_inventory(_before(moves, "last_updated", LOAD_CUTOFF))
    source = silver.fact_inventory(_since(moves, "last_updated", LOAD_CUTOFF))
    return upsert(target, source, silver.INVENTORY_KEYS)


SUMMARY_KEYS = ["customer_name", "product_name", "supplier_name", "warehouse_name", "sale_date"]
SUMMARY_MEASURES = ["total_quantity_sold", "total_sales_amount", "total_tax_collected"]


@query("upsert_partial")
def _upsert_partial(spark, sf_dir):
    """Groups of the first load, their measures still 0, refreshed by the second
    (measures only; NULL-safe keys so re-runs do not repeat NULL groups)."""
    # The sale's day is a group key, so what the first load summed up is a part of the
    # summary; it is derived and written once.  Both sides are grouped by exactly
    # SUMMARY_KEYS: unique by construction.
    summary = _lake(spark, "summary").stage(gold.sales_summary(_silver(spark, sf_dir)))
    first = _before(summary, "sale_date", LOAD_CUTOFF)
    first = first.select(*SUMMARY_KEYS, *[F.lit(0).cast(first.schema[c].dataType).alias(c)
                                          for c in SUMMARY_MEASURES])
    return upsert(first, summary, SUMMARY_KEYS,
                  update_cols=SUMMARY_MEASURES, null_safe_keys=True, check_duplicates=False)


@query("upsert_warehouse_stock")
def _upsert_warehouse_stock(spark, sf_dir):
    """Stock keyed by product and warehouse, several of them each: the first load's movements,
    then the later ones."""
    stock = silver.fact_inventory(driver.warehouse_stock(spark, sf_dir))
    target = _before(stock, "last_updated", LOAD_CUTOFF).withColumn("stock_level", F.lit(0).cast("bigint"))
    return upsert(target, _since(stock, "last_updated", OVERLAP_FROM), silver.INVENTORY_KEYS)


@query("upsert_shipments")
def _upsert_shipments(spark, sf_dir):
    """Shipment fact by order: the first load had no carrier yet."""
    fact = silver.fact_shipments(driver.shipment_events(spark, sf_dir))
    target = _before(fact, "shipment_date", LOAD_CUTOFF).withColumn("carrier_name", F.lit("TBD"))
    return upsert(target, _since(fact, "shipment_date", OVERLAP_FROM), silver.SHIPMENT_KEYS)


FIRST_SHIPPED = "1992-03-01"


def _shipped_early(spark, sf_dir, key):
    lines = _before(driver.table(spark, sf_dir, "lineitem"), "l_shipdate", FIRST_SHIPPED)
    return lines.select(key.alias("early")).distinct()


def _scd1(spark, name, dim, key, early):
    """A type-1 dimension: first the members shipped early, with a location or brand that
    was not known yet; then all of them."""
    lake = _lake(spark, "scd1")
    lake.create_table(f"silver.{name}", schemas.TABLES[f"silver.{name}"])
    known = dim(LOAD_TS).join(early, F.col(key) == F.col("early"), "left_semi")
    for rows, ts in ((known, LOAD_TS), (dim(RUN_TS), RUN_TS)):
        now = silver.ts_literal(ts)
        lake.merge(f"silver.{name}", rows, [key],
                   update_cols=[c for c in rows.columns if c != "created_at"],
                   update_exprs={"updated_at": now},
                   insert_exprs={"created_at": now, "updated_at": now}, check_duplicates=False)
    return lake.table(f"silver.{name}")


@query("scd1_product")
def _scd1_product(spark, sf_dir):
    """Products overwritten in place; created_at stays that of their first load."""
    return _scd1(spark, "dim_product",
                 lambda ts: silver.transform_product(driver.source_product(spark, sf_dir), ts),
                 "product_id", _shipped_early(spark, sf_dir, F.col("l_partkey").cast("int")))


@query("scd1_warehouse")
def _scd1_warehouse(spark, sf_dir):
    """Warehouses overwritten in place; created_at stays that of their first load."""
    return _scd1(spark, "dim_warehouse",
                 lambda ts: silver.transform_warehouse(driver.warehouse_changes(spark, sf_dir), ts),
                 "warehouse_id", _shipped_early(
                     spark, sf_dir, (F.col("l_partkey") % 25).cast("string")))


def _merge_gold(spark, sf_dir, table, **options):
    """A gold summary stored after the first load, then merged with the second load's."""
    from .pipeline import GOLD_MERGES

    lake = _lake(spark, "gold")
    build, keys, measures = GOLD_MERGES[table]
    lake.create_table(table, schemas.TABLES[table])
    s = _staged_silver(spark, sf_dir, lake, names=["fact_sales_order", "dim_customer", "dim_supplier"])
    earlier = silver.Silver(**{**s.tables(), "fact_sales_order": _before(
        s.fact_sales_order, "createddate", LOAD_CUTOFF)})
    for load, ts in ((earlier, LOAD_TS), (s, RUN_TS)):
        lake.merge(table, build(load, RUN_DATE, ts), keys, update_cols=measures, null_safe_keys=True)
    return lake.table(table)


@query("merge_gold_country")
def _merge_gold_country(spark, sf_dir):
    return _merge_gold(spark, sf_dir, "gold.fact_sales_summary_by_country")


@query("merge_gold_daily")
def _merge_gold_daily(spark, sf_dir):
    return _merge_gold(spark, sf_dir, "gold.fact_sales_summary_by_supplier_daily")


@query("merge_gold_monthly")
def _merge_gold_monthly(spark, sf_dir):
    return _merge_gold(spark, sf_dir, "gold.fact_sales_summary_by_supplier_monthly")


#: The second load of the refreshed summaries: its first day.
REFRESH_FROM = "1998-07-31"


def _refresh_gold(spark, sf_dir, table):
    """A summary stored after the first load, then refreshed where the second load's rows fall."""
    lake = _lake(spark, "refresh")
    lake.create_table(table, schemas.TABLES[table])
    s = _staged_silver(spark, sf_dir, lake, names=["fact_sales_order", "dim_customer", "dim_supplier"])
    earlier = silver.Silver(**{**s.tables(), "fact_sales_order": _before(
        s.fact_sales_order, "createddate", REFRESH_FROM)})
    for load, new, ts in ((earlier, earlier.fact_sales_order, LOAD_TS),
                          (s, _since(s.fact_sales_order, "createddate", REFRESH_FROM), RUN_TS)):
        refresh.note(lake, refresh.ORDERS, "createddate", new)
        run = refresh.Refresh(lake, load, RUN_DATE, ts, [table])
        for merge in run.merges:
            merge()
        run.done()
    return lake.table(table)


@query("refresh_gold_daily")
def _refresh_gold_daily(spark, sf_dir):
    """Sales per day and supplier; only the second load's days are computed again."""
    return _refresh_gold(spark, sf_dir, "gold.fact_sales_summary_by_supplier_daily")


@query("refresh_gold_country")
def _refresh_gold_country(spark, sf_dir):
    """Sales per country; only countries of customers in the second load are computed again."""
    return _refresh_gold(spark, sf_dir, "gold.fact_sales_summary_by_country")


@query("merge_supply_chain")
def _merge_supply_chain(spark, sf_dir):
    """The wide order summary merged by order number, first and second load."""
    lake = _lake(spark, "wide")
    table = "gold.fact_supply_chain_summary"
    lake.create_table(table, schemas.TABLES[table])
    s = _staged_silver(spark, sf_dir, lake)
    # The dimensions are the same in both loads, so lines meet them once.
    lines = lake.stage(gold.supply_chain_lines(s), "lines")
    for load in (_before(lines, "createddate", LOAD_CUTOFF), lines):
        lake.merge(table, gold.one_per_order(load, s.fact_shipments), ["salesordernumber"],
                   check_duplicates=False)
    return lake.table(table)


def deliveries_per_day(shipments, run_ts):
    return (shipments.groupBy("supplier_id", "actual_delivery_date")
            .agg(F.count(F.lit(1)).alias("deliveries"))
            .withColumn("last_updated", silver.ts_literal(run_ts)))


@query("upsert_null_keys")
def _upsert_null_keys(spark, sf_dir):
    """Deliveries per supplier and day, merged with MERGE's NULL rule: the
    undelivered group (NULL day) never matches, so it is inserted again."""
    ships = driver.shipment_events(spark, sf_dir)
    target = deliveries_per_day(_before(ships, "shipment_date", LOAD_CUTOFF), LOAD_TS)
    source = deliveries_per_day(ships, RUN_TS)
    return upsert(target, source, ["supplier_id", "actual_delivery_date"])


@query("merge_null_partition")
def _merge_null_partition(spark, sf_dir):
    """Deliveries per supplier and month in a table partitioned by month; what is not
    delivered yet lies in the NULL partition, whose old rows stay (NULL matches nothing)."""
    lake = _lake(spark, "deliveries")
    name = "gold.deliveries"
    lake.create_table(name, "supplier_id string, deliveries bigint, delivery_month string",
                      ["delivery_month"])
    ships = driver.shipment_events(spark, sf_dir).withColumn(
        "delivery_month", F.date_format("actual_delivery_date", "yyyy-MM"))
    for part in (_before(ships, "shipment_date", LOAD_CUTOFF), ships):
        lake.merge(name, part.groupBy("supplier_id", "delivery_month")
                   .agg(F.count(F.lit(1)).alias("deliveries")), ["supplier_id", "delivery_month"])
    return lake.table(name)


# --- SCD2 ----------------------------------------------------------------------

def _customer_dim_as_of(spark, sf_dir, run_ts, before=None, since=None):
    snap = driver.customer_snapshot(spark, sf_dir, before)
    if since is not None:
        snap = _since(snap, "UpdatedAt", since)
    return silver.transform_customer(snap, run_ts, loyalty=driver.loyalty_tier(F.col("order_count")))


@query("scd2_customer")
def _scd2_customer(spark, sf_dir):
    """Customer dimension after the first load, then the second load's
    changes (loyalty tier moves with the order count) as new versions."""
    target = _customer_dim_as_of(spark, sf_dir, LOAD_TS, before=LOAD_CUTOFF)
    source = _customer_dim_as_of(spark, sf_dir, RUN_TS, since=LOAD_CUTOFF)
    return scd2(target, source, "customer_id", silver.CUSTOMER_COMPARE, RUN_TS)


@query("scd2_null_keys")
def _scd2_null_keys(spark, sf_dir):
    """The same loads where the second feed lost the ids of one region's customers: a NULL
    key matches nothing, so each is a new version and the known ones stay current."""
    target = _customer_dim_as_of(spark, sf_dir, LOAD_TS, before=LOAD_CUTOFF)
    source = _customer_dim_as_of(spark, sf_dir, RUN_TS, since=LOAD_CUTOFF)
    source = source.withColumn("customer_id", F.when(
        F.col("country") == LOST_REGION, F.lit(None)).otherwise(F.col("customer_id")))
    return scd2(target, source, "customer_id", silver.CUSTOMER_COMPARE, RUN_TS)


LOST_REGION = "AFRICA"


def _one_change_each(df, key, columns):
    """Each row with one of its compared columns changed, or none; all columns come up."""
    which = F.col(key).cast("bigint") % (len(columns) + 1)
    return df.select(*[
        F.when(which == columns.index(c), F.concat(F.col(c), F.lit("*"))).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c) for c in df.columns])


@query("scd2_customer_changes")
def _scd2_customer_changes(spark, sf_dir):
    """Customers that change in every compared column, one column each, or not at all."""
    target = _customer_dim_as_of(spark, sf_dir, LOAD_TS, before=LOAD_CUTOFF)
    source = _one_change_each(_customer_dim_as_of(spark, sf_dir, RUN_TS), "customer_id",
                              silver.CUSTOMER_COMPARE)
    return scd2(target, source, "customer_id", silver.CUSTOMER_COMPARE, RUN_TS)


@query("scd2_supplier")
def _scd2_supplier(spark, sf_dir):
    """Supplier dimension, first load then the suppliers active since."""
    stamp = ["created_at", "updated_at"]
    target = silver.first_load(silver.transform_supplier(
        driver.supplier_snapshot(spark, sf_dir, LOAD_CUTOFF), LOAD_TS), LOAD_TS, stamp)
    source = silver.transform_supplier(
        _since(driver.supplier_snapshot(spark, sf_dir), "UpdatedAt", LOAD_CUTOFF), RUN_TS)
    return scd2(target, source, "supplier_id", silver.SUPPLIER_COMPARE, RUN_TS)


@query("customer_versions")
def _customer_versions(spark, sf_dir):
    """Point lookup of one customer's versions by its id given as text (the
    id compared to the INT key is cast implicitly).  The id looked up is the
    customer with the most orders."""
    dim = QUERIES["scd2_customer"](spark, sf_dir)
    busiest = (driver.table(spark, sf_dir, "orders").groupBy("o_custkey")
               .agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), F.col("o_custkey").asc()).limit(1).first())
    wanted = str(busiest["o_custkey"])
    return dim.where(F.col("customer_id") == F.lit(wanted)).select(
        "customer_name", "region", "country", "loyalty_status", "start_date", "end_date",
        "is_current")


# --- files -------------------------------------------------------------------


def _workdir(spark, name):
    return scratch_path(spark, "queries", f"{name}-{uuid.uuid4().hex}")


def _lake(spark, name):
    """A fresh lake (own folder, own catalog databases) for one query run."""
    tag = uuid.uuid4().hex[:12]
    return Lakehouse(spark, _workdir(spark, name), prefix=f"q{tag}_", buckets=16)


def _staged_silver(spark, sf_dir, lake=None, names=None):
    """Silver tables written once to shared storage and read back, for
    queries that derive several results from them (as the pipeline does).
    Only `names` are staged (default all); the others stay lazy plans."""
    lake = lake or _lake(spark, "silver")
    built = _silver(spark, sf_dir).tables()
    names = set(names or built)
    staged = lake.stage_many({n: df for n, df in built.items() if n in names})
    return silver.Silver(**{n: staged.get(n, df) for n, df in built.items()})


DIMS = ["dim_customer", "dim_product", "dim_supplier", "dim_warehouse"]


# Known feed defect used to exercise the corrupt-row path on whole tables:
# urgent orders are keyed in by hand and their quantity arrives as text.
HAND_KEYED = "1-URGENT"


@query("csv_corrupt_filter")
def _csv_corrupt_filter(spark, sf_dir):
    """Order feed written as CSV (hand-keyed urgent lines carry a text
    quantity), read back with the declared schema; corrupt rows dropped."""
    folder = _workdir(spark, "orders-csv")
    lines = driver.order_lines(spark, sf_dir)
    quantity = F.when(F.col("ordertype") == HAND_KEYED,
                      F.concat(F.col("quantity").cast("string"), F.lit(" pcs"))
                      ).otherwise(F.col("quantity").cast("string"))
    lines.withColumn("quantity", quantity).write.option("header", True).csv(folder)
    return files.read_order_csv(spark, folder)


@query("json_multiline")
def _json_multiline(spark, sf_dir):
    """Inventory feed as pretty-printed JSON arrays, read back."""
    folder = _workdir(spark, "inventory-json")
    files.write_json_arrays(driver.inventory_snapshots(spark, sf_dir), folder)
    return files.read_json_documents(spark, folder, schemas.INVENTORY_JSON)


@query("json_lines")
def _json_lines(spark, sf_dir):
    """Shipment feed as JSON Lines files, read back."""
    folder = _workdir(spark, "shipment-json")
    files.write_json_lines(driver.shipment_events(spark, sf_dir), folder)
    return files.read_json_lines(spark, folder, schemas.SHIPMENT_JSON)


def _drops(spark, sf_dir):
    folder = _workdir(spark, "drops")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))     # archives of each feed, at most
    files.write_drops(driver.order_lines(spark, sf_dir).coalesce(width), folder,
                      "sales_orders", "csv").count()
    files.write_drops(driver.inventory_snapshots(spark, sf_dir), folder, "inventory",
                      "json", "array").count()
    files.write_drops(driver.shipment_events(spark, sf_dir).coalesce(width), folder,
                      "shipment", "json", "lines").count()
    # An older inventory feed without the sku_name field: fails its check.
    old = driver.inventory_snapshots(spark, sf_dir).drop("sku_name")
    files.write_drops(old, folder, "inventory_legacy", "json", "array").count()
    return folder


@query("zip_extract")
def _zip_extract(spark, sf_dir):
    """Order rows recovered from zip drops (members found by name, checked,
    parsed line by line)."""
    lines = files.extract_archives(spark, _drops(spark, sf_dir))
    accepted = lines.where((F.col("kind") == "sales_orders") & (F.col("status") == files.VALID))
    return files.parse_orders_lines(accepted)


@query("schema_check")
def _schema_check(spark, sf_dir):
    """Records by the verdict on their archive member."""
    return files.verdict_summary(files.extract_archives(spark, _drops(spark, sf_dir)))


@query("json_quarantine")
def _json_quarantine(spark, sf_dir):
    """The inventory feed dropped four times: whole, cut off in the middle, with a broken last
    line, and without a field.  Only the whole one lands and is read back."""
    folder, root = _workdir(spark, "drops"), _workdir(spark, "landing")
    feed = driver.inventory_snapshots(spark, sf_dir)
    for kind, layout, rows, spoil in (
            ("inventory_whole", "array", feed, None),
            ("inventory_cut", "array", feed, lambda size: (size // 2, "")),
            ("inventory_broken", "lines", feed, lambda size: (size, '{"inventory_id": \n')),
            ("inventory_legacy", "array", feed.drop("sku_name"), None)):
        files.write_drops(rows, folder, kind, "json", layout, spoil=spoil).count()
    files.land(files.extract_archives(spark, folder), root, RUN_TS)
    return files.read_landed_json(spark, files.landed(root, "inventory"), schemas.INVENTORY_JSON,
                                  {"array"}, RUN_DATE, "00")


@query("landing_paths")
def _landing_paths(spark, sf_dir):
    """Where the drops landed: kind, layout, date and hour of the landing folders."""
    root = _workdir(spark, "landing")
    files.land(files.extract_archives(spark, _drops(spark, sf_dir)), root, RUN_TS)
    return (spark.read.text(f"{root}/landing")
            .select("kind", "layout", F.col("ingest_date").cast("string").alias("ingest_date"),
                    F.lpad(F.col("ingest_hour").cast("string"), 2, "0").alias("ingest_hour"))
            .distinct())


# --- writers -------------------------------------------------------------------

@query("daily_reload")
def _daily_reload(spark, sf_dir):
    """Overstock report reloaded for two days, the second day twice: the
    table keeps one copy per day."""
    lake = _lake(spark, "lake")
    name = "gold.inventory_overstock_inactive"
    lake.create_table(name, schemas.OVERSTOCK_INACTIVE)
    s = _staged_silver(spark, sf_dir, lake, names=["fact_inventory"])
    for day in (IDLE_RUN_DATE, SECOND_IDLE_RUN_DATE, SECOND_IDLE_RUN_DATE):
        lake.reload_day(name, gold.overstock_inactive(s, day), day)
    return lake.table(name)


SECOND_IDLE_RUN_DATE = "2001-12-15"
EARLIER_RUN_DATE = "1998-06-01"


@query("rebuild_table")
def _rebuild_table(spark, sf_dir):
    """Shipping performance rebuilt twice (create or replace)."""
    lake = _lake(spark, "lake")
    s = _staged_silver(spark, sf_dir, lake, names=["fact_sales_order", "fact_shipments"])
    for _ in range(2):
        lake.rebuild("gold.fact_shipping_performance", gold.shipping_performance(s))
    return lake.table("gold.fact_shipping_performance")


@query("publish_upsert")
def _publish_upsert(spark, sf_dir):
    """Order fact published to the mart by key, first and second load."""
    lake = _lake(spark, "lake")
    name = "mart.fact_sales_order"
    lake.create_table(name, schemas.FACT_SALES_ORDER)
    fact = silver.fact_sales_order(silver.valid_orders(_flagged(spark, sf_dir)))
    first = _before(fact, "createddate", LOAD_CUTOFF).withColumn(
        "taxamount", F.lit(0).cast("decimal(7,4)"))
    lake.publish_upsert(name, first, silver.ORDER_KEYS)
    lake.publish_upsert(name, _since(fact, "createddate", OVERLAP_FROM), silver.ORDER_KEYS)
    return lake.table(name)


@query("publish_snapshot")
def _publish_snapshot(spark, sf_dir):
    """Late-delivery report published for two days; the mart keeps the latest."""
    lake = _lake(spark, "lake")
    s = _staged_silver(spark, sf_dir, lake, names=["fact_sales_order", "fact_shipments"])
    for day in (EARLIER_RUN_DATE, RUN_DATE):
        lake.publish_snapshot("mart.late_deliveries_daily", gold.late_deliveries(s, day))
    return lake.table("mart.late_deliveries_daily")


@query("publish_inventory")
def _publish_inventory(spark, sf_dir):
    """Stock published to the mart by key, first and second load; dates become dates."""
    lake = _lake(spark, "mart")
    name = "mart.fact_inventory"
    lake.create_table(name, MART_TABLES[name])
    moves = driver.inventory_movements(spark, sf_dir)
    for part in (_before(moves, "last_updated", LOAD_CUTOFF), _since(moves, "last_updated", LOAD_CUTOFF)):
        lake.publish_upsert(name, silver.fact_inventory(part).withColumn(
            "last_movement_date", F.try_to_date("last_movement_date")), silver.INVENTORY_KEYS)
    return lake.table(name)


@query("publish_shipments")
def _publish_shipments(spark, sf_dir):
    """Shipments published to the mart by order, first and second load."""
    lake = _lake(spark, "mart")
    name = "mart.fact_shipments"
    lake.create_table(name, MART_TABLES[name])
    fact = silver.fact_shipments(driver.shipment_events(spark, sf_dir)).withColumn(
        "promised_delivery_date", F.try_to_date("promised_delivery_date"))
    first = _before(fact, "shipment_date", LOAD_CUTOFF).withColumn("carrier_name", F.lit("TBD"))
    for part in (first, _since(fact, "shipment_date", OVERLAP_FROM)):
        lake.publish_upsert(name, part, silver.SHIPMENT_KEYS)
    return lake.table(name)


@query("publish_dimensions")
def _publish_dimensions(spark, sf_dir):
    """The four dimensions copied to the mart twice; every row of the copies, as text."""
    lake = _lake(spark, "mart")
    dims = _staged_silver(spark, sf_dir, lake, names=DIMS).tables()
    for name in DIMS * 2:
        lake.publish_snapshot(f"mart.{name}", dims[name])
    return reduce(DataFrame.unionByName, [_as_text(lake.table(f"mart.{n}"), f"mart.{n}") for n in DIMS])


def _as_text(df, name):
    """(table_name, content): each row's values in column order, NULLs as `-`, split by `|`;
    times without a zone and to the second."""
    values = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind.startswith("timestamp") else F.col(c).cast("string")
              for c, kind in df.dtypes]
    return df.select(F.lit(name).alias("table_name"),
                     F.concat_ws("|", *[F.coalesce(v, F.lit("-")) for v in values]).alias("content"))


@query("append_rows")
def _append_rows(spark, sf_dir):
    """Rejected order lines appended in two loads."""
    lake = _lake(spark, "append")
    rejects = lake.stage(silver.rejected_orders(_flagged(spark, sf_dir)))
    lake.rebuild("silver.order_rejects", rejects.where(F.col("createddate") < LOAD_CUTOFF))
    lake.append("silver.order_rejects", rejects.where(
        F.col("createddate").isNull() | (F.col("createddate") >= LOAD_CUTOFF)))
    return lake.table("silver.order_rejects")


# --- incremental source, audit, stream -------------------------------------------

FIRST_EVENT_LOAD = "2024-01-15"


@query("incremental_events")
def _incremental_events(spark, sf_dir):
    """Events changed after the bookmark a first load (up to FIRST_EVENT_LOAD)
    left; the filter is pushed into the scan."""
    events = driver.table(spark, sf_dir, "events")
    marks = incremental.Bookmarks(spark, _workdir(spark, "bookmarks"))
    first = _before(events, "ts", FIRST_EVENT_LOAD)
    marks.advance("events", first, "ts", RUN_TS)
    return incremental.above_mark(events, "ts", marks.get("events"))


@query("late_events")
def _late_events(spark, sf_dir):
    """Events that a second load finds when some (every seventh) of the first load's time were
    committed after it: from two days behind the bookmark, less those loaded before."""
    events = driver.table(spark, sf_dir, "events")
    marks = incremental.Bookmarks(spark, _workdir(spark, "bookmarks"))
    loaded = _before(events, "ts", FIRST_EVENT_LOAD).where(F.col("event_id") % 7 != 3)
    marks.advance("events", loaded, "ts", RUN_TS)
    start = incremental.overlapped(marks.get("events"), dt.timedelta(days=2))
    return incremental.unseen(incremental.above_mark(events, "ts", start), loaded, "event_id", "ts", start)


AUDIT_GOLD = [
    "fact_sales_summary", "fact_sales_summary_by_country",
    "fact_sales_summary_by_supplier_daily", "fact_sales_summary_by_supplier_monthly",
    "fact_supply_chain_summary", "high_shipping_orders", "inventory_overstock_inactive",
    "late_deliveries_daily", "order_stock_shortage", "sales_order_lead_time",
    "supplier_delivery_performance",
]


def gold_tables(s, run_date=RUN_DATE, run_ts=RUN_TS, idle_run_date=IDLE_RUN_DATE, lines=None):
    return {
        "fact_sales_summary": gold.sales_summary(s, lines=lines),
        "fact_sales_summary_by_country": gold.sales_by_country(s, run_ts),
        "fact_sales_summary_by_supplier_daily": gold.sales_by_supplier_daily(s, run_ts),
        "fact_sales_summary_by_supplier_monthly": gold.sales_by_supplier_monthly(s, run_ts),
        "fact_supply_chain_summary": gold.supply_chain_summary(s, lines=lines),
        "fact_shipping_performance": gold.shipping_performance(s),
        "aggregated_inventory_levels": gold.inventory_levels(s),
        "high_shipping_orders": gold.high_shipping_orders(s, run_date),
        "inventory_overstock_inactive": gold.overstock_inactive(s, idle_run_date),
        "late_deliveries_daily": gold.late_deliveries(s, run_date),
        "order_stock_shortage": gold.order_stock_shortage(s, run_date),
        "sales_order_lead_time": gold.order_lead_time(s, run_date),
        "supplier_delivery_performance": gold.supplier_delivery_performance(s, run_date),
        "upcoming_stock_shortage": gold.upcoming_stock_shortage(s, run_date),
    }


@query("row_count_audit")
def _row_count_audit(spark, sf_dir):
    """Row counts of the 7 silver and 11 audited gold tables, as stored: the counts are taken
    from the files' footers, no column is read."""
    lake = _lake(spark, "audit")
    s = _staged_silver(spark, sf_dir, lake)
    # Both wide reports read the lines joined with the dimensions once.
    g = gold_tables(s, lines=lake.stage(gold.named_lines(s), "lines"))
    stored = lake.stage_many({n: g[n] for n in AUDIT_GOLD})
    tables = {f"silver.{n}": df for n, df in sorted(s.tables().items())}
    tables.update({f"gold.{n}": stored[n] for n in AUDIT_GOLD})
    return gold.row_count_audit(tables)


@query("stream_upsert")
def _stream_upsert(spark, sf_dir):
    """Two order drops arrive (first load, then an overlapping second load);
    the stream is started after each and processes only the new files."""
    from ..streaming.ingest import run_available

    work = _workdir(spark, "stream")
    lake = Lakehouse(spark, f"{work}/lake", prefix=f"q{uuid.uuid4().hex[:12]}_")
    name = "silver.fact_sales_order"
    lake.create_table(name, schemas.FACT_SALES_ORDER)
    lines = driver.order_lines(spark, sf_dir)
    drops = [_before(lines, "createddate", LOAD_CUTOFF), _since(lines, "createddate", OVERLAP_FROM)]
    for i, drop in enumerate(drops):
        drop.write.option("header", True).option("compression", "gzip").csv(f"{work}/landing/drop={i}")
        run_available(spark, f"{work}/landing/drop=*", lake, name, f"{work}/checkpoint")
    return lake.table(name)


@query("stream_drops")
def _stream_drops(spark, sf_dir):
    """Two loads of shipments, overlapping in time, dropped as zip archives of JSON Lines: a stream
    of archives unpacks, checks, lands and loads those that are new, at each of two starts."""
    from ..streaming.ingest import run_available_drops

    work = _workdir(spark, "stream-drops")
    lake = Lakehouse(spark, f"{work}/lake", prefix=f"q{uuid.uuid4().hex[:12]}_", buckets=16)
    ships = driver.shipment_events(spark, sf_dir)
    for i, drop in enumerate([_before(ships, "shipment_date", LOAD_CUTOFF), _since(ships, "shipment_date", OVERLAP_FROM)]):
        files.write_drops(drop, f"{work}/drops/{i}", "shipment", "json", "lines").count()
        run_available_drops(spark, f"{work}/drops/*", lake, f"{work}/landing", f"{work}/checkpoint", RUN_TS)
    return lake.table("silver.fact_shipments")


@query("lake_scd2_customer")
def _lake_scd2_customer(spark, sf_dir):
    """The two loads of `scd2_customer` into the stored, versioned customer dimension."""
    lake = _lake(spark, "versions")
    lake.create_table("silver.dim_customer", schemas.TABLES["silver.dim_customer"])
    for ts, window in ((LOAD_TS, {"before": LOAD_CUTOFF}), (RUN_TS, {"since": LOAD_CUTOFF})):
        lake.merge_scd2("silver.dim_customer", _customer_dim_as_of(spark, sf_dir, ts, **window),
                        "customer_id", silver.CUSTOMER_COMPARE, ts)
    return lake.table("silver.dim_customer")


@query("quarantined_lines")
def _quarantined_lines(spark, sf_dir):
    """What lies in the error folder after the inventory feed was dropped as JSON lines without
    a field: every record, with the hour's folder it lies in."""
    folder, root = _workdir(spark, "drops"), _workdir(spark, "landing")
    feed = driver.inventory_snapshots(spark, sf_dir).drop("sku_name")
    files.write_drops(feed, folder, "inventory_legacy", "json", "lines").count()
    files.land(files.extract_archives(spark, folder), root, RUN_TS)
    record = F.from_json("value", "inventory_id string, product_id string, warehouse_id string, stock_level bigint")
    return (spark.read.text(f"{root}/error_data").select(
        record.alias("r"), F.col("ingest_date").cast("string").alias("ingest_date"),
        F.lpad(F.col("ingest_hour").cast("string"), 2, "0").alias("ingest_hour"))
        .select("r.*", "ingest_date", "ingest_hour"))
