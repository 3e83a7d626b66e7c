"""Table and file schemas of the lakehouse (bronze, silver, gold, mart).

Every table is a flat record of scalars.  DDL strings are Spark's
`StructType.fromDDL` syntax so they can be used both for `read.schema(...)`
and for `CREATE TABLE`.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values: file kinds and the column names each kind must carry ----
# Kind names are matched as substrings of a member file name, first match in
# this order: sales_orders, inventory, shipment.
EXPECTED_COLUMNS = {
    "sales_orders": [
        "salesordernumber", "salesorderlinenumber", "createddate", "processeddate",
        "ordertype", "quantity", "unitprice", "taxamount", "customer_id",
        "product_id", "supplier_id", "warehouse_id",
    ],
    "inventory": [
        "inventory_id", "product_id", "sku_name", "warehouse_id", "stock_level",
        "daily_usage_rate", "unit_cost", "reorder_point", "product_category",
        "supplier_id", "inventory_status", "last_movement_date", "last_updated",
    ],
    "shipment": [
        "shipment_id", "salesordernumber", "purchase_order_id", "product_id",
        "supplier_id", "carrier_name", "shipment_date", "promised_delivery_date",
        "expected_delivery_date", "actual_delivery_date", "quantity_shipped",
        "shipping_cost", "delivery_status", "delivery_location",
    ],
}
FILE_KINDS = ["sales_orders", "inventory", "shipment"]
# ---------------------------------------------------------------------------

# Read schema of the order CSV, including the corrupt-record column.
ORDER_CSV = (
    "salesordernumber string, salesorderlinenumber int, createddate timestamp, "
    "processeddate timestamp, ordertype string, quantity int, unitprice double, "
    "taxamount double, customer_id int, product_id int, supplier_id string, "
    "warehouse_id string, _corrupt_record string"
)

# JSON files are read with a declared schema: all values arrive as text or
# numbers; dates are parsed afterwards with try_* functions.
INVENTORY_JSON = (
    "inventory_id string, product_id string, sku_name string, warehouse_id string, "
    "stock_level bigint, daily_usage_rate double, unit_cost double, reorder_point bigint, "
    "product_category string, supplier_id string, inventory_status string, "
    "last_movement_date string, last_updated string"
)
SHIPMENT_JSON = (
    "shipment_id string, salesordernumber string, purchase_order_id string, "
    "product_id string, supplier_id string, carrier_name string, shipment_date string, "
    "promised_delivery_date string, expected_delivery_date string, "
    "actual_delivery_date string, quantity_shipped bigint, shipping_cost double, "
    "delivery_status string, delivery_location string"
)

# --- bronze (relational source copies) -------------------------------------
BRONZE_CUSTOMER = (
    "CustomerID int, FirstName string, LastName string, CompanyName string, "
    "EmailAddress string, Phone string, AddressLine1 string, City string, "
    "CountryRegion string, PostalCode string, CreatedAt timestamp, UpdatedAt timestamp"
)
BRONZE_PRODUCT = (
    "ProductID int, Name string, ProductNumber string, Color string, "
    "StandardCost decimal(18,2), ListPrice decimal(18,2), Size string, "
    "Weight decimal(10,2), ProductCategoryID int, ProductModelID int, "
    "SellStartDate date, ThumbnailPhotoFileName string, rowguid string, "
    "CreatedAt timestamp, UpdatedAt timestamp"
)
BRONZE_SUPPLIER = (
    "SupplierID string, SupplierName string, ContactName string, Email string, "
    "Phone string, Address string, City string, State string, Country string, "
    "PostalCode string, BusinessCategory string, CreatedAt timestamp, UpdatedAt timestamp"
)
BRONZE_WAREHOUSE = (
    "WarehouseID string, WarehouseName string, Location string, City string, "
    "State string, Country string, PostalCode string, Capacity int, "
    "CreatedAt timestamp, UpdatedAt timestamp"
)

# --- silver -----------------------------------------------------------------
DIM_CUSTOMER = (
    "customer_id int, customer_name string, email string, phone string, region string, "
    "country string, customer_type string, loyalty_status string, start_date timestamp, "
    "end_date timestamp, is_current boolean, created_at timestamp, updated_at timestamp"
)
DIM_PRODUCT = (
    "product_id int, product_name string, category string, sub_category string, "
    "brand string, supplier_id string, unit_price double, cost_price double, "
    "sell_start_date timestamp, thumbnail_photo string, created_at timestamp, "
    "updated_at timestamp"
)
DIM_SUPPLIER = (
    "supplier_id string, supplier_name string, contact_name string, email string, "
    "phone string, address string, city string, state string, country string, "
    "postal_code string, business_category string, start_date timestamp, "
    "end_date timestamp, is_current boolean, created_at timestamp, updated_at timestamp"
)
DIM_WAREHOUSE = (
    "warehouse_id string, warehouse_name string, location string, city string, "
    "state string, country string, postal_code string, capacity int, "
    "created_at timestamp, updated_at timestamp"
)
FACT_SALES_ORDER = (
    "salesordernumber string, createddate date, processeddate date, quantity int, "
    "unitprice decimal(8,4), taxamount decimal(7,4), customer_id int, product_id int, "
    "supplier_id string, warehouse_id string"
)
FACT_INVENTORY = (
    "inventory_id string, product_id string, warehouse_id string, stock_level bigint, "
    "last_updated timestamp, daily_usage_rate double, inventory_status string, "
    "last_movement_date string, product_category string, reorder_point bigint, "
    "sku_name string, supplier_id string, unit_cost double"
)
FACT_SHIPMENTS = (
    "shipment_id string, salesordernumber string, shipment_date date, "
    "delivery_status string, expected_delivery_date date, actual_delivery_date date, "
    "carrier_name string, delivery_location string, product_id string, "
    "promised_delivery_date string, purchase_order_id string, quantity_shipped bigint, "
    "shipping_cost decimal(18,2), supplier_id string"
)

# --- gold ---------------------------------------------------------------------
SALES_SUMMARY = (
    "customer_name string, product_name string, supplier_name string, "
    "warehouse_name string, sale_date date, total_quantity_sold bigint, "
    "total_sales_amount decimal(18,2), total_tax_collected decimal(18,4)"
)
SALES_BY_COUNTRY = (
    "country string, total_sales_amount decimal(18,2), total_quantity_sold bigint, "
    "total_orders bigint, last_updated timestamp"
)
SALES_BY_SUPPLIER_DAILY = (
    "sales_date date, supplier_id string, supplier_name string, "
    "total_sales_amount decimal(18,2), total_quantity_sold bigint, total_orders bigint, "
    "last_updated timestamp"
)
SALES_BY_SUPPLIER_MONTHLY = (
    "sales_month string, supplier_id string, supplier_name string, "
    "total_sales_amount decimal(18,2), total_quantity_sold bigint, total_orders bigint, "
    "last_updated timestamp"
)
SUPPLY_CHAIN_SUMMARY = (
    "salesordernumber string, createddate date, processeddate date, quantity int, "
    "unitprice decimal(10,2), taxamount decimal(10,2), customer_id string, "
    "customer_name string, product_id string, product_name string, supplier_id string, "
    "supplier_name string, warehouse_id string, warehouse_name string, "
    "current_stock_level int, shipment_date date, delivery_status string"
)
LATE_DELIVERIES = (
    "salesordernumber string, createddate date, expected_delivery_date date, "
    "actual_delivery_date date, delivery_status string, run_date date"
)
OVERSTOCK_INACTIVE = (
    "inventory_id string, product_id string, stock_level bigint, reorder_point bigint, "
    "last_movement_date date, days_since_last_movement int, run_date date"
)
HIGH_SHIPPING_ORDERS = (
    "salesordernumber string, total_shipping_cost decimal(28,2), "
    "shipments_per_order bigint, run_date date"
)
ORDER_STOCK_SHORTAGE = (
    "salesordernumber string, createddate date, processeddate date, "
    "order_processing_delay int, stock_level bigint, warehouse_id string, run_date date"
)
SUPPLIER_DELIVERY_PERFORMANCE = (
    "supplier_id string, total_shipments bigint, delayed_shipments bigint, "
    "on_time_pct double, run_date date"
)
UPCOMING_STOCK_SHORTAGE = (
    "product_id string, stock_level bigint, total_demand bigint, net_stock bigint, "
    "run_date date"
)
SALES_ORDER_LEAD_TIME = (
    "salesordernumber string, createddate date, last_delivery date, "
    "total_lead_time int, run_date date"
)

# Partition column per table (only tables listed here are partitioned).
PARTITIONS = {
    "fact_sales_order": ["createddate"],
    "late_deliveries_daily": ["run_date"],
    "inventory_overstock_inactive": ["run_date"],
    "high_shipping_orders": ["run_date"],
    "order_stock_shortage": ["run_date"],
    "supplier_delivery_performance": ["run_date"],
    "upcoming_stock_shortage": ["run_date"],
    "sales_order_lead_time": ["run_date"],
}

# Tables that merges write by a key: stored in buckets by a hash of it.
BUCKETS = {
    "bronze.customer": ["CustomerID"],
    "bronze.product": ["ProductID"],
    "bronze.supplier": ["SupplierID"],
    "bronze.warehouse": ["WarehouseID"],
    "silver.dim_customer": ["customer_id"],
    "silver.dim_supplier": ["supplier_id"],
    "silver.dim_product": ["product_id"],
    "silver.dim_warehouse": ["warehouse_id"],
    "silver.fact_inventory": ["product_id", "warehouse_id"],
    "silver.fact_shipments": ["salesordernumber"],
    "gold.fact_sales_summary": ["sale_date"],
    "gold.fact_sales_summary_by_supplier_daily": ["sales_date"],
    "gold.fact_sales_summary_by_supplier_monthly": ["sales_month"],
    "gold.fact_supply_chain_summary": ["salesordernumber"],
    "mart.fact_inventory": ["product_id", "warehouse_id"],
    "mart.fact_shipments": ["salesordernumber"],
}
# Type-2 tables: current versions in buckets, closed ones by load.
VERSIONED = {"silver.dim_customer", "silver.dim_supplier"}

TABLES = {
    "bronze.customer": BRONZE_CUSTOMER,
    "bronze.product": BRONZE_PRODUCT,
    "bronze.supplier": BRONZE_SUPPLIER,
    "bronze.warehouse": BRONZE_WAREHOUSE,
    "silver.dim_customer": DIM_CUSTOMER,
    "silver.dim_product": DIM_PRODUCT,
    "silver.dim_supplier": DIM_SUPPLIER,
    "silver.dim_warehouse": DIM_WAREHOUSE,
    "silver.fact_sales_order": FACT_SALES_ORDER,
    "silver.fact_inventory": FACT_INVENTORY,
    "silver.fact_shipments": FACT_SHIPMENTS,
    "gold.fact_sales_summary": SALES_SUMMARY,
    "gold.fact_sales_summary_by_country": SALES_BY_COUNTRY,
    "gold.fact_sales_summary_by_supplier_daily": SALES_BY_SUPPLIER_DAILY,
    "gold.fact_sales_summary_by_supplier_monthly": SALES_BY_SUPPLIER_MONTHLY,
    "gold.fact_supply_chain_summary": SUPPLY_CHAIN_SUMMARY,
    "gold.late_deliveries_daily": LATE_DELIVERIES,
    "gold.inventory_overstock_inactive": OVERSTOCK_INACTIVE,
    "gold.high_shipping_orders": HIGH_SHIPPING_ORDERS,
    "gold.order_stock_shortage": ORDER_STOCK_SHORTAGE,
    "gold.supplier_delivery_performance": SUPPLIER_DELIVERY_PERFORMANCE,
    "gold.upcoming_stock_shortage": UPCOMING_STOCK_SHORTAGE,
    "gold.sales_order_lead_time": SALES_ORDER_LEAD_TIME,
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
