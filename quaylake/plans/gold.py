"""Gold layer: summaries and daily reports over the silver tables.

Each function is pure: silver DataFrames and the run's clock values in, one
DataFrame out.  Writing (merge, daily partition reload, rebuild, publish) is
the caller's choice, see `quaylake.sinks.writers`.

Scale notes
* Dimensions join by plain equi-joins: AQE broadcasts one whose measured
  shuffle size lies below `spark.sql.adaptive.autoBroadcastJoinThreshold`,
  else splits skewed partitions.  Building a report runs no Spark job.
* Facts join facts on keys that are unique on one side (silver keeps one
  shipment per order, one stock row per product and warehouse), so no join
  multiplies rows.
* Aggregates are partial before the shuffle; COUNT(DISTINCT) is expanded by
  Spark into a two-level aggregate keyed by (group, value), so one large group
  does not land in one task.  Sales by supplier and period have many small groups
  instead: their lines are dealt out by the group, in one shuffle for both levels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import keep_one
from .silver import Silver, delivery_status, ts_literal

AMOUNT = "decimal(18,2)"
TAX = "decimal(18,4)"


def _date(value) -> Column:
    return F.lit(str(value)).cast("date")


def _dims(silver: Silver, dims: str = "current") -> dict[str, DataFrame]:
    """Dimension rows to join.  'current' keeps the open SCD2 version only;
    'all' joins every version as the original jobs did (one sale then counts
    once per version)."""
    customer, supplier = silver.dim_customer, silver.dim_supplier
    if dims == "current":
        customer = customer.where(F.col("is_current"))
        supplier = supplier.where(F.col("is_current"))
    return {
        "customer": customer,
        "product": silver.dim_product,
        "supplier": supplier,
        "warehouse": silver.dim_warehouse,
    }


def _sales_amount() -> Column:
    # quantity * unit price summed in DECIMAL: exact and independent of order.
    return F.sum(F.col("quantity") * F.col("unitprice")).cast(AMOUNT)


# --- G1-G4: sales summaries ---------------------------------------------------

def sales_summary(silver: Silver, dims: str = "current", lines: DataFrame | None = None) -> DataFrame:
    """G1: customer x product x supplier x warehouse x day (of `lines`, if `named_lines` are at hand)."""
    if lines is not None:
        return _summed_by_names(lines)
    d = _dims(silver, dims)
    f = silver.fact_sales_order.select(
        "customer_id", "product_id", "supplier_id", "warehouse_id", "createddate",
        "quantity", "unitprice", "taxamount")
    c = d["customer"].select("customer_id", "customer_name")
    p = d["product"].select("product_id", "product_name")
    s = d["supplier"].select("supplier_id", "supplier_name")
    w = d["warehouse"].select("warehouse_id", "warehouse_name")
    joined = (
        f.join(c, "customer_id", "left")
        .join(p, "product_id", "left")
        .join(s, "supplier_id", "left")
        .join(w, "warehouse_id", "left")
    )
    return _summed_by_names(joined)


def _summed_by_names(lines: DataFrame) -> DataFrame:
    return lines.groupBy(
        "customer_name", "product_name", "supplier_name", "warehouse_name",
        F.to_date("createddate").alias("sale_date"),
    ).agg(
        F.sum("quantity").cast("bigint").alias("total_quantity_sold"),
        _sales_amount().alias("total_sales_amount"),
        F.sum("taxamount").cast(TAX).alias("total_tax_collected"),
    )


def _sales_totals(run_ts) -> list[Column]:
    return [
        _sales_amount().alias("total_sales_amount"),
        F.sum("quantity").cast("bigint").alias("total_quantity_sold"),
        F.countDistinct("salesordernumber").alias("total_orders"),
    ]


def sales_by_country(silver: Silver, run_ts, dims: str = "current") -> DataFrame:
    """Sales per customer country."""
    c = _dims(silver, dims)["customer"].select("customer_id", "country")
    f = silver.fact_sales_order.select("customer_id", "salesordernumber", "quantity", "unitprice")
    return (
        f.join(c, "customer_id", "left")
        .groupBy("country")
        .agg(*_sales_totals(run_ts))
        .withColumn("last_updated", ts_literal(run_ts))
    )


def _by_supplier(silver: Silver, period: Column, run_ts, dims: str) -> DataFrame:
    s = _dims(silver, dims)["supplier"].select("supplier_id", "supplier_name")
    f = silver.fact_sales_order.select(
        F.col("supplier_id").alias("f_supplier_id"), "createddate", "salesordernumber",
        "quantity", "unitprice")
    keys = [period, s.supplier_id, F.col("supplier_name")]
    # Dealt out by the group, which serves the distinct orders as well: lines move once.
    joined = f.join(s, f.f_supplier_id == s.supplier_id, "left").select(
        *keys, "salesordernumber", "quantity", "unitprice")
    names = joined.columns[:len(keys)]
    return (
        joined.repartition(*names).groupBy(*names)
        .agg(*_sales_totals(run_ts))
        .withColumn("last_updated", ts_literal(run_ts))
    )


def sales_by_supplier_daily(silver: Silver, run_ts, dims: str = "current") -> DataFrame:
    """Sales per day and supplier."""
    return _by_supplier(silver, F.to_date("createddate").alias("sales_date"), run_ts, dims)


def sales_by_supplier_monthly(silver: Silver, run_ts, dims: str = "current") -> DataFrame:
    """Sales per 'yyyy-MM' month and supplier."""
    return _by_supplier(
        silver, F.date_format("createddate", "yyyy-MM").alias("sales_month"), run_ts, dims)


# --- G5: one wide row per order ------------------------------------------------

SUPPLY_CHAIN_COLUMNS = [
    "salesordernumber", "createddate", "processeddate", "quantity", "unitprice",
    "taxamount", "customer_id", "customer_name", "product_id", "product_name",
    "supplier_id", "supplier_name", "warehouse_id", "warehouse_name",
    "current_stock_level", "shipment_date", "delivery_status",
]
#: What the wide summary needs of the facts it meets.
SUPPLY_CHAIN_FACTS = {
    "fact_inventory": ["product_id", "warehouse_id", "stock_level"],
    "fact_shipments": ["salesordernumber", "shipment_date", "delivery_status"],
}


def stock_per_product(inventory: DataFrame) -> DataFrame:
    """First stock level per product in ascending order, NULL first.

    An order line meets every warehouse's stock row of its product; the wide
    summary then keeps one row per order, preferring (after the shipment
    date and the line's own columns) the lowest stock, NULL first.  Reducing
    stock to that one value per product before the join gives the same row
    without multiplying lines by warehouses.
    """
    return inventory.groupBy("product_id").agg(
        F.when(F.count("*") > F.count("stock_level"), F.lit(None))
        .otherwise(F.min("stock_level")).cast("int").alias("current_stock_level"))


def _items(silver: Silver, product: DataFrame) -> DataFrame:
    """Products with their stock: stock meets the products, not the lines, so the lines are
    shuffled once for both."""
    p = product.select("product_id", "product_name", F.col("supplier_id").alias("p_supplier_id"))
    stock = stock_per_product(silver.fact_inventory).withColumnRenamed("product_id", "i_product_id")
    return p.join(stock, p.product_id.cast("string") == stock.i_product_id, "left").drop("i_product_id")


def named_lines(silver: Silver, dims: str = "current") -> DataFrame:
    """Every order line with its dimensions' names and stock, NULL where it meets none, and
    whether it meets all four (`known`): one join for the reports G1 and G5 of a run."""
    d = _dims(silver, dims)
    f = silver.fact_sales_order
    c = d["customer"].select("customer_id", "customer_name", F.lit(True).alias("c_known"))
    p = _items(silver, d["product"]).withColumn("p_known", F.lit(True))
    s = d["supplier"].select(
        F.col("supplier_id").alias("s_supplier_id"), "supplier_name", F.lit(True).alias("s_known"))
    w = d["warehouse"].select("warehouse_id", "warehouse_name", F.lit(True).alias("w_known"))
    joined = (
        f.join(c, "customer_id", "left")
        .join(p, "product_id", "left")
        .join(s, f.supplier_id == s.s_supplier_id, "left")
        .join(w, "warehouse_id", "left")
    )
    known = reduce(lambda a, b: a & b, [F.col(f"{x}_known").isNotNull() for x in "cpsw"])
    return joined.select(
        "salesordernumber", "createddate", "processeddate", "quantity", "unitprice", "taxamount",
        "customer_id", "customer_name", "product_id", "product_name", "p_supplier_id", "supplier_name",
        "warehouse_id", "warehouse_name", "current_stock_level", known.alias("known"))


def supply_chain_lines(silver: Silver, dims: str = "current", lines: DataFrame | None = None) -> DataFrame:
    """Order lines with their dimensions and stock, for `one_per_order`.

    The supplier id is the product's (always 'Unknown' from the product
    source), the supplier name comes through the line's own supplier.
    """
    if lines is not None:
        return _wide(lines.where("known"))
    d = _dims(silver, dims)
    f = silver.fact_sales_order
    c = d["customer"].select("customer_id", "customer_name")
    s = d["supplier"].select(
        F.col("supplier_id").alias("s_supplier_id"), "supplier_name")
    w = d["warehouse"].select("warehouse_id", "warehouse_name")
    return _wide(
        f.join(c, "customer_id")
        .join(_items(silver, d["product"]), "product_id")
        .join(s, f.supplier_id == s.s_supplier_id)
        .join(w, "warehouse_id"))


def _wide(joined: DataFrame) -> DataFrame:
    return joined.select(
        "salesordernumber", "createddate", "processeddate", "quantity",
        F.col("unitprice").cast("decimal(10,2)").alias("unitprice"),
        F.col("taxamount").cast("decimal(10,2)").alias("taxamount"),
        "customer_id", "customer_name", "product_id", "product_name",
        F.col("p_supplier_id").alias("supplier_id"), "supplier_name",
        "warehouse_id", "warehouse_name", "current_stock_level",
    )


def one_per_order(lines: DataFrame, shipments: DataFrame) -> DataFrame:
    """Of the lines of an order, each with its order's shipments, the one with the latest."""
    ship = shipments.select(
        F.col("salesordernumber").alias("sh_order"), "shipment_date", "delivery_status")
    met = lines.join(ship, lines.salesordernumber == ship.sh_order, "left")
    # Ids become text after the lines were shuffled: numbers are shorter.
    text = {c: F.col(c).cast("string") for c in ("customer_id", "product_id")}
    rows = met.withColumns(text).select(*SUPPLY_CHAIN_COLUMNS)
    return keep_one(rows, ["salesordernumber"], ["shipment_date DESC NULLS LAST"])


def supply_chain_summary(silver: Silver, dims: str = "current", lines: DataFrame | None = None) -> DataFrame:
    """Order line with its dimensions, stock and latest shipment, one per order (of `lines`,
    if `named_lines` are at hand)."""
    return one_per_order(supply_chain_lines(silver, dims, lines), silver.fact_shipments)


# --- G6, G7: rebuilt tables ------------------------------------------------------

def shipping_performance(silver: Silver) -> DataFrame:
    """Each order line with its order's shipment: duration and status."""
    f = silver.fact_sales_order.select("salesordernumber")
    s = silver.fact_shipments.select(
        "salesordernumber", "shipment_date", "expected_delivery_date", "actual_delivery_date")
    return f.join(s, "salesordernumber").select(
        "salesordernumber", "shipment_date", "expected_delivery_date", "actual_delivery_date",
        F.datediff("actual_delivery_date", "shipment_date").alias("delivery_duration_days"),
        delivery_status().alias("delivery_status"),
    )


def inventory_levels(silver: Silver) -> DataFrame:
    """Stock per update time, product and warehouse."""
    i = silver.fact_inventory.select("last_updated", "product_id", "warehouse_id", "stock_level")
    p = silver.dim_product.select(
        F.col("product_id").cast("string").alias("p_product_id"), "product_name")
    w = silver.dim_warehouse.select(
        F.col("warehouse_id").alias("w_warehouse_id"), "warehouse_name")
    return (
        i.join(p, i.product_id == p.p_product_id)
        .join(w, i.warehouse_id == w.w_warehouse_id)
        .groupBy("last_updated", "product_id", "product_name", "warehouse_id", "warehouse_name")
        .agg(F.sum("stock_level").cast("bigint").alias("total_stock"))
    )


# --- G8-G14: daily reports (carry run_date) --------------------------------------

def late_deliveries(silver: Silver, run_date) -> DataFrame:
    """Lines whose shipment is past its expected date, late or undelivered."""
    f = silver.fact_sales_order.select("salesordernumber", "createddate")
    s = silver.fact_shipments.select(
        "salesordernumber", "expected_delivery_date", "actual_delivery_date", "delivery_status")
    late = (F.col("expected_delivery_date") < _date(run_date)) & (
        F.col("actual_delivery_date").isNull()
        | (F.col("actual_delivery_date") > F.col("expected_delivery_date")))
    return (
        f.join(s, "salesordernumber", "left").where(late)
        .select("salesordernumber", "createddate", "expected_delivery_date",
                "actual_delivery_date", "delivery_status")
        .withColumn("run_date", _date(run_date))
    )


def overstock_inactive(silver: Silver, run_date, factor: int = 2, idle_days: int = 30) -> DataFrame:
    """Stock above factor x reorder point and no movement for idle_days."""
    moved = F.try_to_date(F.col("last_movement_date"))
    idle = F.datediff(_date(run_date), moved)
    return (
        silver.fact_inventory
        .where((F.col("stock_level") > F.col("reorder_point") * factor) & (idle > idle_days))
        .select("inventory_id", "product_id", "stock_level", "reorder_point",
                moved.alias("last_movement_date"), idle.alias("days_since_last_movement"))
        .withColumn("run_date", _date(run_date))
    )


def high_shipping_orders(silver: Silver, run_date, min_cost: float = 800,
                         min_shipments: int = 3) -> DataFrame:
    """Orders with shipping cost above min_cost or more than min_shipments."""
    # Dealt out by the order, which serves the distinct shipments as well: rows move once.
    dealt = silver.fact_shipments.select(
        "salesordernumber", "shipment_id", "shipping_cost").repartition("salesordernumber")
    return (
        dealt.groupBy("salesordernumber")
        .agg(F.sum("shipping_cost").cast("decimal(28,2)").alias("total_shipping_cost"),
             F.countDistinct("shipment_id").alias("shipments_per_order"))
        .where((F.col("total_shipping_cost") > min_cost)
               | (F.col("shipments_per_order") > min_shipments))
        .withColumn("run_date", _date(run_date))
    )


def order_stock_shortage(silver: Silver, run_date) -> DataFrame:
    """Order lines asking for more than their warehouse holds."""
    f = silver.fact_sales_order.select(
        "salesordernumber", "createddate", "processeddate", "quantity",
        F.col("product_id").cast("string").alias("f_product_id"),
        F.col("warehouse_id").alias("f_warehouse_id"))
    i = silver.fact_inventory.select("product_id", "warehouse_id", "stock_level")
    cond = (f.f_product_id == i.product_id) & (f.f_warehouse_id == i.warehouse_id) & (
        i.stock_level < f.quantity)
    return f.join(i, cond).select(
        "salesordernumber", "createddate", "processeddate",
        F.datediff("processeddate", "createddate").alias("order_processing_delay"),
        "stock_level", i.warehouse_id,
    ).withColumn("run_date", _date(run_date))


def supplier_delivery_performance(silver: Silver, run_date) -> DataFrame:
    """Shipments, delayed shipments and on-time share per supplier.

    Undelivered shipments count in the total only."""
    late = F.col("actual_delivery_date") > F.col("expected_delivery_date")
    on_time = F.col("actual_delivery_date") <= F.col("expected_delivery_date")
    total = F.count(F.lit(1))
    return (
        silver.fact_shipments.groupBy("supplier_id")
        .agg(total.alias("total_shipments"),
             F.sum(F.when(late, 1).otherwise(0)).cast("bigint").alias("delayed_shipments"),
             F.round(F.lit(100.0).cast("decimal(4,1)")
                     * F.sum(F.when(on_time, 1).otherwise(0)) / total, 2)
             .cast("double").alias("on_time_pct"))
        .withColumn("run_date", _date(run_date))
    )


def upcoming_stock_shortage(silver: Silver, run_date, horizon_days: int = 14) -> DataFrame:
    """Products whose demand of the next horizon_days exceeds their stock."""
    start = _date(run_date)
    demand = (
        silver.fact_sales_order
        .where(F.col("createddate").between(start, F.date_add(start, horizon_days)))
        .groupBy(F.col("product_id").cast("string").alias("d_product_id"))
        .agg(F.sum("quantity").cast("bigint").alias("total_demand"))
    )
    i = silver.fact_inventory.select("product_id", "stock_level")
    return (
        i.join(demand, i.product_id == demand.d_product_id)
        .select("product_id", "stock_level", "total_demand",
                (F.col("stock_level") - F.col("total_demand")).alias("net_stock"))
        .where(F.col("net_stock") < 0)
        .withColumn("run_date", _date(run_date))
    )


def order_lead_time(silver: Silver, run_date) -> DataFrame:
    """Per order and creation date, last delivery and days to it."""
    f = silver.fact_sales_order.select("salesordernumber", "createddate")
    s = silver.fact_shipments.select("salesordernumber", "actual_delivery_date")
    return (
        f.join(s, "salesordernumber")
        .groupBy("salesordernumber", "createddate")
        .agg(F.max("actual_delivery_date").alias("last_delivery"))
        .withColumn("total_lead_time", F.datediff("last_delivery", "createddate"))
        .withColumn("run_date", _date(run_date))
    )


# --- G15, G16: report and audit ----------------------------------------------------

TOP_SUPPLIER_ORDER = [
    "sales_date DESC", "supplier_id ASC", "supplier_name ASC", "total_sales_amount ASC",
    "total_quantity_sold ASC", "total_orders ASC", "last_updated ASC",
]


def top_supplier_sales(daily: DataFrame, n: int = 10) -> DataFrame:
    """The n most recent supplier-day rows (a top-n report)."""
    from ..functions.ordering import sort_column

    return (
        daily.where(F.col("supplier_id").isNotNull())
        .select("sales_date", "supplier_id", "supplier_name", "total_sales_amount",
                "total_quantity_sold", "total_orders", "last_updated")
        .orderBy(*[sort_column(s) for s in TOP_SUPPLIER_ORDER])
        .limit(n)
    )


def row_count_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named table, as one UNION ALL."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
