"""Source feeds derived from the driver's TPC-H-style tables.

The pipeline expects four relational source tables (Customer, Product,
Supplier, Warehouse) and three file feeds (order lines, inventory snapshots,
shipments).  These functions derive them from `region nation customer
supplier part orders lineitem` so every query works on whole tables and grows
with them.  All columns are built with JVM-side expressions; the joins are
plain equi-joins that Spark plans (broadcast when a side is small by its own
size estimate, sort-merge otherwise, re-planned by AQE at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Warehouses are the 25 nations; products are spread over them by key.
WAREHOUSE_COUNT = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(base: str, offset: Column) -> Column:
    """`base` date plus `offset` days, as a timestamp at midnight."""
    return F.date_add(F.lit(base).cast("date"), offset.cast("int")).cast("timestamp")


# --- relational sources (bronze shape) -------------------------------------

def source_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            key.cast("int").alias("CustomerID"),
            F.substring_index("c_name", "#", 1).alias("FirstName"),
            F.concat(F.lit("#"), F.substring_index("c_name", "#", -1)).alias("LastName"),
            F.col("c_mktsegment").alias("CompanyName"),
            F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")).alias("EmailAddress"),
            F.concat((F.col("c_nationkey") + 10).cast("string"), F.lit("-"), key.cast("string")).alias("Phone"),
            F.concat(key.cast("string"), F.lit(" Main St")).alias("AddressLine1"),
            F.col("n_name").alias("City"),
            F.col("r_name").alias("CountryRegion"),
            (F.lit(10000) + key % 90000).cast("string").alias("PostalCode"),
            _day("1995-01-01", F.lit(0)).alias("CreatedAt"),
            _day("1998-01-01", key % 365).alias("UpdatedAt"),
        )
    )


def source_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.cast("int").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.concat(F.lit("PN-"), key.cast("string")).alias("ProductNumber"),
        F.col("p_brand").alias("Color"),
        (F.col("p_retailprice").cast("decimal(18,2)") - 100).cast("decimal(18,2)").alias("StandardCost"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("ListPrice"),
        F.col("p_size").cast("string").alias("Size"),
        F.lit(None).cast("decimal(10,2)").alias("Weight"),
        F.col("p_size").alias("ProductCategoryID"),
        (key % 50).cast("int").alias("ProductModelID"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 1000).cast("int")).alias("SellStartDate"),
        F.concat(F.lit("p"), key.cast("string"), F.lit(".gif")).alias("ThumbnailPhotoFileName"),
        F.col("p_type").alias("rowguid"),
        _day("1995-01-01", F.lit(0)).alias("CreatedAt"),
        _day("1998-01-01", key % 365).alias("UpdatedAt"),
    )


def source_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region")
    key = F.col("s_suppkey")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            key.cast("string").alias("SupplierID"),
            F.col("s_name").alias("SupplierName"),
            F.concat(F.lit("Contact "), key.cast("string")).alias("ContactName"),
            F.concat(F.lit("supplier"), key.cast("string"), F.lit("@example.com")).alias("Email"),
            F.concat((F.col("s_nationkey") + 10).cast("string"), F.lit("-"), key.cast("string")).alias("Phone"),
            F.concat(key.cast("string"), F.lit(" Harbour Rd")).alias("Address"),
            F.col("n_name").alias("City"),
            F.col("r_name").alias("State"),
            F.col("n_name").alias("Country"),
            (F.lit(20000) + key % 70000).cast("string").alias("PostalCode"),
            F.when(F.col("s_acctbal") < 0, "Distressed").otherwise("Active").alias("BusinessCategory"),
            _day("1995-01-01", F.lit(0)).alias("CreatedAt"),
            _day("1998-01-01", key % 365).alias("UpdatedAt"),
        )
    )


def source_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        key.cast("string").alias("WarehouseID"),
        F.col("n_name").alias("WarehouseName"),
        F.col("r_name").alias("Location"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("State"),
        F.col("n_name").alias("Country"),
        (F.lit(30000) + key).cast("string").alias("PostalCode"),
        ((key + 1) * 1000).cast("int").alias("Capacity"),
        _day("1995-01-01", F.lit(0)).alias("CreatedAt"),
        _day("1998-01-01", key).alias("UpdatedAt"),
    )


# --- file feeds ---------------------------------------------------------------

def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as the order feed delivers them (types of the CSV read)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .select(
            F.col("l_orderkey").cast("string").alias("salesordernumber"),
            F.col("l_linenumber").alias("salesorderlinenumber"),
            F.col("o_orderdate").cast("timestamp").alias("createddate"),
            F.col("l_shipdate").cast("timestamp").alias("processeddate"),
            F.col("o_orderpriority").alias("ordertype"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("p_retailprice").alias("unitprice"),
            F.col("l_tax").alias("taxamount"),
            F.col("o_custkey").cast("int").alias("customer_id"),
            F.col("l_partkey").cast("int").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("supplier_id"),
            (F.col("l_partkey") % WAREHOUSE_COUNT).cast("string").alias("warehouse_id"),
        )
    )


def defective_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order feed with every kind of defect, spread over all lines by line number and
    product: missing and negative values, and dates as text, some out of order."""
    lines = order_lines(spark, sf_dir)
    kind = (F.col("product_id") + F.col("salesorderlinenumber")) % 11

    def broken(name: str, number: int, value=None) -> Column:
        bad = F.lit(None) if value is None else value
        return F.when(kind == number, bad.cast(lines.schema[name].dataType)).otherwise(F.col(name))

    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return lines.select(
        "salesordernumber", "salesorderlinenumber",
        text(broken("createddate", 8)).alias("createddate"),
        text(broken("processeddate", 9, F.date_sub("createddate", 1))).alias("processeddate"),
        "ordertype",
        F.when(kind == 0, F.lit(None).cast("int")).when(kind == 1, -F.col("quantity"))
        .otherwise(F.col("quantity")).alias("quantity"),
        broken("unitprice", 3).alias("unitprice"),
        broken("taxamount", 2, -1 - F.col("taxamount")).alias("taxamount"),
        broken("customer_id", 4).alias("customer_id"),
        broken("product_id", 5).alias("product_id"),
        broken("supplier_id", 6).alias("supplier_id"),
        broken("warehouse_id", 7).alias("warehouse_id"),
    )


def warehouse_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock records of products that lie in several warehouses each (one for every
    warehouse that a supplier of the product ships from), with times as text."""
    lines = (table(spark, sf_dir, "lineitem")
             .groupBy("l_partkey", (F.col("l_suppkey") % WAREHOUSE_COUNT).cast("string").alias("wh"))
             .agg(F.max("l_quantity").cast("bigint").alias("stock"), F.max("l_shipdate").alias("moved")))
    snap = inventory_snapshots(spark, sf_dir)
    stock = snap.join(lines, snap.product_id == lines.l_partkey.cast("string"))
    return stock.select(
        F.concat("inventory_id", F.lit("-"), "wh").alias("inventory_id"), "product_id", "sku_name",
        F.col("wh").alias("warehouse_id"), F.col("stock").alias("stock_level"), "daily_usage_rate",
        "unit_cost", "reorder_point", "product_category", "supplier_id",
        F.when(F.col("stock") < F.col("reorder_point"), "LOW").otherwise("OK").alias("inventory_status"),
        F.col("moved").cast("date").cast("string").alias("last_movement_date"),
        F.date_format("moved", "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
    )


def inventory_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stock record per product in its warehouse, as the inventory feed sends it.

    The last movement of a product is its latest ship date: a group-by on the
    line table (partial aggregation before the shuffle) joined back by key.
    """
    p = table(spark, sf_dir, "part")
    moves = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.max("l_shipdate").alias("last_move"))
    )
    key = F.col("p_partkey")
    last_move = F.col("last_move").cast("timestamp")
    return p.join(moves, p.p_partkey == moves.l_partkey, "left").select(
        F.concat(F.lit("INV-"), key.cast("string")).alias("inventory_id"),
        key.cast("string").alias("product_id"),
        F.col("p_name").alias("sku_name"),
        (key % WAREHOUSE_COUNT).cast("string").alias("warehouse_id"),
        F.col("p_size").cast("bigint").alias("stock_level"),
        (F.col("p_size") / 10.0).alias("daily_usage_rate"),
        F.col("p_retailprice").alias("unit_cost"),
        (key % 20).cast("bigint").alias("reorder_point"),
        F.col("p_type").alias("product_category"),
        F.lit(None).cast("string").alias("supplier_id"),
        F.when(F.col("p_size") < key % 20, "LOW").otherwise("OK").alias("inventory_status"),
        last_move.cast("date").cast("string").alias("last_movement_date"),
        last_move.alias("last_updated"),
    )


def shipment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shipment per order line, as the shipment feed sends it.

    Undelivered lines (open and not returned) have no actual delivery date.
    """
    li = table(spark, sf_dir, "lineitem")
    ship = F.col("l_shipdate").cast("date")
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("shipment_id"),
        F.col("l_orderkey").cast("string").alias("salesordernumber"),
        F.concat(F.lit("PO-"), F.col("l_orderkey").cast("string")).alias("purchase_order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("supplier_id"),
        F.concat(F.lit("Carrier-"), F.col("l_returnflag")).alias("carrier_name"),
        ship.alias("shipment_date"),
        F.date_add(ship, 10).cast("string").alias("promised_delivery_date"),
        F.date_add(ship, 7).alias("expected_delivery_date"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.lit(None).cast("date"))
        .otherwise(F.date_add(ship, (F.col("l_quantity") % 14).cast("int"))).alias("actual_delivery_date"),
        F.col("l_quantity").cast("bigint").alias("quantity_shipped"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("shipping_cost"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), "In Transit")
        .otherwise("Delivered").alias("delivery_status"),
        F.col("l_linestatus").alias("delivery_location"),
    )


# --- change logs and snapshots (incremental loads) ---------------------------
#
# A source record is touched whenever the business acts on it: a customer
# record by each of its orders, a supplier and a warehouse by each shipped
# line.  The change logs below carry one bronze row per touch with
# UpdatedAt = the touch time, so a load that keeps the latest row per key
# sees real duplicates, and a snapshot "as of T" is just the touches before T.

def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bronze customer row per order of the customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    base = source_customer(spark, sf_dir).drop("UpdatedAt")
    return base.join(o, base.CustomerID == o.o_custkey.cast("int")).select(
        *[c for c in base.columns], F.col("o_orderdate").cast("timestamp").alias("UpdatedAt"))


def supplier_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bronze supplier row per shipped line of the supplier."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate")
    base = source_supplier(spark, sf_dir).drop("UpdatedAt")
    return base.join(li, base.SupplierID == li.l_suppkey.cast("string")).select(
        *[c for c in base.columns], F.col("l_shipdate").cast("timestamp").alias("UpdatedAt"))


def warehouse_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bronze warehouse row per line shipped from it (25 hot keys)."""
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % WAREHOUSE_COUNT).cast("string").alias("wh"), "l_shipdate")
    base = source_warehouse(spark, sf_dir).drop("UpdatedAt")
    return base.join(li, base.WarehouseID == li.wh).select(
        *[c for c in base.columns], F.col("l_shipdate").cast("timestamp").alias("UpdatedAt"))


def inventory_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stock record per shipped line of the product (the inventory feed
    over time); the latest per product and warehouse is the current stock."""
    p = table(spark, sf_dir, "part")
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
    snap = inventory_snapshots(spark, sf_dir).drop("last_movement_date", "last_updated")
    moved = F.col("l_shipdate").cast("timestamp")
    return snap.join(li, snap.product_id == li.l_partkey.cast("string")).select(
        *snap.columns,
        moved.cast("date").cast("string").alias("last_movement_date"),
        moved.alias("last_updated"),
    )


def loyalty_tier(orders: Column) -> Column:
    return F.when(orders >= 12, "Gold").when(orders >= 6, "Silver").otherwise("Bronze")


def _touches(df: DataFrame, key: str, time: str, before: str | None) -> DataFrame:
    """First, last and number of the touches of each key (before a time)."""
    moment = F.col(time).cast("timestamp")
    if before is not None:
        df = df.where(moment < F.lit(before).cast("timestamp"))
    return df.groupBy(key).agg(F.min(moment).alias("CreatedAt"), F.max(moment).alias("UpdatedAt"),
                               F.count(F.lit(1)).alias("touches"))


def customer_snapshot(spark: SparkSession, sf_dir: str, before: str | None = None) -> DataFrame:
    """Bronze customers as of `before`: those with an order before it, with
    CreatedAt / UpdatedAt = first / last such order and their order count.  Orders are
    summed up by their integer key before they meet the wide customer rows."""
    base = source_customer(spark, sf_dir).drop("CreatedAt", "UpdatedAt")
    touches = _touches(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", before)
    return base.join(touches, base.CustomerID == touches.o_custkey.cast("int")).select(
        *base.columns, "CreatedAt", "UpdatedAt", F.col("touches").alias("order_count"))


def supplier_snapshot(spark: SparkSession, sf_dir: str, before: str | None = None,
                      large_from: int = 300) -> DataFrame:
    """Bronze suppliers as of `before`; BusinessCategory is 'Large' once the
    supplier has shipped `large_from` lines, else 'Small'."""
    base = source_supplier(spark, sf_dir).drop("CreatedAt", "UpdatedAt", "BusinessCategory")
    touches = _touches(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate", before)
    return base.join(touches, base.SupplierID == touches.l_suppkey.cast("string")).select(
        *base.columns, "CreatedAt", "UpdatedAt",
        F.when(F.col("touches") >= large_from, "Large").otherwise("Small").alias("BusinessCategory"))
