"""Silver layer: cleaned, de-duplicated facts and conformed dimensions.

All functions are DataFrame in, DataFrame out.  Keys follow the lakehouse's
merge keys, so a silver table holds at most one row per key:

* fact_sales_order  (createddate, customer_id, product_id), earliest processing
* fact_inventory    (product_id, warehouse_id), latest update
* fact_shipments    (salesordernumber), latest shipment
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import schemas
from ..functions import quality
from ..operators.dedup import keep_one

CUSTOMER_COMPARE = ["customer_name", "email", "phone", "region", "country",
                    "customer_type", "loyalty_status"]
SUPPLIER_COMPARE = ["supplier_name", "contact_name", "email", "phone", "address", "city",
                    "state", "country", "postal_code", "business_category"]
ORDER_KEYS = ["createddate", "customer_id", "product_id"]
ORDER_PICK = ["processeddate ASC"]
INVENTORY_KEYS = ["product_id", "warehouse_id"]
INVENTORY_PICK = ["last_updated DESC"]
SHIPMENT_KEYS = ["salesordernumber"]
SHIPMENT_PICK = ["shipment_date DESC"]


def ts_literal(value: datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp")


def _columns(ddl: str) -> list[str]:
    return schemas.struct(ddl).fieldNames()


# --- facts ------------------------------------------------------------------

def flag_orders(raw: DataFrame) -> DataFrame:
    """Quality verdict per order line, then the narrowing casts.

    Rules see the values as read; casts use try_cast so a value that passes
    the rules but does not fit (tax >= 1000 in DECIMAL(7,4)) becomes NULL
    instead of failing the job.  Dates become DATE: the merge key compares
    dates, and a DATE never equals a TIMESTAMP with a time of day.
    """
    flagged = quality.flag(raw)
    return flagged.select(
        "salesordernumber",
        F.col("quantity").try_cast("int").alias("quantity"),
        F.col("taxamount").try_cast("decimal(7,4)").alias("taxamount"),
        F.col("unitprice").try_cast("decimal(8,4)").alias("unitprice"),
        F.col("customer_id").try_cast("int").alias("customer_id"),
        F.col("product_id").try_cast("int").alias("product_id"),
        F.col("createddate").cast("date").alias("createddate"),
        F.col("processeddate").cast("date").alias("processeddate"),
        "supplier_id",
        "warehouse_id",
        "error_description",
        "error_flag",
    )


def valid_orders(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("error_flag") == 0)


def rejected_orders(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("error_flag") == 1)


def fact_sales_order(valid: DataFrame, keys: list[str] = ORDER_KEYS) -> DataFrame:
    """One row per order key: the earliest processed line."""
    rows = valid.select(*_columns(schemas.FACT_SALES_ORDER))
    return keep_one(rows, keys, ORDER_PICK)


def _as_date(name: str, dtype) -> Column:
    return F.try_to_date(F.col(name)) if isinstance(dtype, StringType) else F.col(name).cast("date")


def fact_inventory(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Latest stock record per product and warehouse (its `columns`, if not all are wanted)."""
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    last = F.col("last_updated")
    if isinstance(types["last_updated"], StringType):
        last = F.try_to_timestamp(last)
    rows = raw.withColumn("last_updated", last.cast("timestamp")).select(
        *_columns(schemas.FACT_INVENTORY))
    return keep_one(rows, INVENTORY_KEYS, INVENTORY_PICK, columns=columns)


def delivery_status(actual: str = "actual_delivery_date",
                    expected: str = "expected_delivery_date") -> Column:
    """'Delayed' when delivered after the expected date; otherwise (also
    when not yet delivered) 'On Time'."""
    return F.when(F.col(actual) > F.col(expected), "Delayed").otherwise("On Time")


def fact_shipments(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Dates parsed, status derived, latest shipment per order kept (its `columns`, if not all
    are wanted)."""
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    rows = raw
    for name in ("shipment_date", "expected_delivery_date", "actual_delivery_date"):
        rows = rows.withColumn(name, _as_date(name, types[name]))
    rows = rows.withColumn("delivery_status", delivery_status())
    rows = rows.withColumn("shipping_cost", F.col("shipping_cost").try_cast("decimal(18,2)"))
    rows = rows.select(*_columns(schemas.FACT_SHIPMENTS))
    return keep_one(rows, SHIPMENT_KEYS, SHIPMENT_PICK, columns=columns)


# --- dimensions ---------------------------------------------------------------

def transform_customer(src: DataFrame, run_ts, loyalty: Column | None = None) -> DataFrame:
    """Source customer rows -> dim_customer rows (latest per customer).

    Loyalty is 'Bronze' unless a `loyalty` expression over the source row is
    given."""
    latest = keep_one(src, ["CustomerID"], ["UpdatedAt DESC"])
    now = ts_literal(run_ts)
    return latest.select(
        F.col("CustomerID").cast("int").alias("customer_id"),
        F.concat("FirstName", F.lit(" "), "LastName").alias("customer_name"),
        F.col("EmailAddress").alias("email"),
        F.col("Phone").alias("phone"),
        F.col("City").alias("region"),
        F.col("CountryRegion").alias("country"),
        F.col("CompanyName").alias("customer_type"),
        (F.lit("Bronze") if loyalty is None else loyalty).alias("loyalty_status"),
        now.alias("start_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
        F.lit(True).alias("is_current"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def transform_product(src: DataFrame, run_ts) -> DataFrame:
    """Source product rows -> dim_product rows (latest per product)."""
    latest = keep_one(src, ["ProductID"], ["UpdatedAt DESC"])
    now = ts_literal(run_ts)
    return latest.select(
        F.col("ProductID").cast("int").alias("product_id"),
        F.col("Name").alias("product_name"),
        F.col("ProductCategoryID").cast("string").alias("category"),
        F.col("ProductModelID").cast("string").alias("sub_category"),
        F.lit("Unknown").alias("brand"),
        F.lit("Unknown").alias("supplier_id"),
        F.col("ListPrice").cast("double").alias("unit_price"),
        F.col("StandardCost").cast("double").alias("cost_price"),
        F.col("SellStartDate").cast("timestamp").alias("sell_start_date"),
        F.col("ThumbnailPhotoFileName").alias("thumbnail_photo"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def transform_supplier(src: DataFrame, run_ts) -> DataFrame:
    """Source supplier rows -> dim_supplier rows (latest per supplier)."""
    latest = keep_one(src, ["SupplierID"], ["UpdatedAt DESC"])
    now = ts_literal(run_ts)
    return latest.select(
        F.col("SupplierID").alias("supplier_id"),
        F.col("SupplierName").alias("supplier_name"),
        F.col("ContactName").alias("contact_name"),
        F.col("Email").alias("email"),
        F.col("Phone").alias("phone"),
        F.col("Address").alias("address"),
        F.col("City").alias("city"),
        F.col("State").alias("state"),
        F.col("Country").alias("country"),
        F.col("PostalCode").alias("postal_code"),
        F.col("BusinessCategory").alias("business_category"),
        now.alias("start_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
        F.lit(True).alias("is_current"),
        F.col("CreatedAt").cast("timestamp").alias("created_at"),
        F.col("UpdatedAt").cast("timestamp").alias("updated_at"),
    )


def transform_warehouse(src: DataFrame, run_ts) -> DataFrame:
    """Source warehouse rows -> dim_warehouse rows (latest per warehouse)."""
    latest = keep_one(src, ["WarehouseID"], ["UpdatedAt DESC"])
    return latest.select(
        F.col("WarehouseID").alias("warehouse_id"),
        F.col("WarehouseName").alias("warehouse_name"),
        F.col("Location").alias("location"),
        F.col("City").alias("city"),
        F.col("State").alias("state"),
        F.col("Country").alias("country"),
        F.col("PostalCode").alias("postal_code"),
        F.col("Capacity").cast("int").alias("capacity"),
        F.col("CreatedAt").cast("timestamp").alias("created_at"),
        F.col("UpdatedAt").cast("timestamp").alias("updated_at"),
    )


def first_load(dim: DataFrame, run_ts, stamp: list[str]) -> DataFrame:
    """Rows as inserted into an empty dimension: `stamp` columns get run_ts."""
    now = ts_literal(run_ts)
    return dim.withColumns({c: now for c in stamp})


@dataclass
class Silver:
    """The seven silver tables one gold run reads."""
    fact_sales_order: DataFrame
    fact_inventory: DataFrame
    fact_shipments: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_supplier: DataFrame
    dim_warehouse: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def from_driver(spark, sf_dir: str, run_ts, columns: dict[str, list[str]] | None = None) -> Silver:
    """Silver tables as a first load from the driver's tables would leave them; of the stock and
    shipment facts only `columns`, if they are named."""
    from ..sources import driver

    columns = columns or {}
    flagged = flag_orders(driver.order_lines(spark, sf_dir))
    return Silver(
        fact_sales_order=fact_sales_order(valid_orders(flagged)),
        fact_inventory=fact_inventory(driver.inventory_snapshots(spark, sf_dir), columns.get("fact_inventory")),
        fact_shipments=fact_shipments(driver.shipment_events(spark, sf_dir), columns.get("fact_shipments")),
        dim_customer=transform_customer(driver.source_customer(spark, sf_dir), run_ts),
        dim_product=transform_product(driver.source_product(spark, sf_dir), run_ts),
        dim_supplier=first_load(
            transform_supplier(driver.source_supplier(spark, sf_dir), run_ts), run_ts,
            ["created_at", "updated_at"]),
        dim_warehouse=first_load(
            transform_warehouse(driver.source_warehouse(spark, sf_dir), run_ts), run_ts,
            ["created_at", "updated_at"]),
    )
