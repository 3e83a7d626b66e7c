"""Silver and gold semantics on hand-written rows."""

from decimal import Decimal

from conftest import rows
from quaylake.functions import quality
from quaylake.plans import gold, silver
from quaylake.sources import files

ORDER = ("salesordernumber string, salesorderlinenumber int, createddate timestamp, "
         "processeddate timestamp, ordertype string, quantity int, unitprice double, "
         "taxamount double, customer_id int, product_id int, supplier_id string, "
         "warehouse_id string")


def order(spark, data):
    return spark.createDataFrame(data, ORDER)


def line(**kw):
    base = dict(salesordernumber="1", salesorderlinenumber=1,
                createddate="2024-01-01 10:00:00", processeddate="2024-01-02 00:00:00",
                ordertype="A", quantity=1, unitprice=2.5, taxamount=0.1, customer_id=1,
                product_id=1, supplier_id="s", warehouse_id="w")
    base.update(kw)
    return base


def test_first_failing_rule_names_the_row(spark):
    from datetime import datetime
    data = [line(quantity=-1, taxamount=None), line(customer_id=None, product_id=None),
            line(processeddate="2023-12-31 00:00:00"), line()]
    cols = ORDER.split(", ")
    df = spark.createDataFrame(
        [tuple(datetime.fromisoformat(d[c.split()[0]]) if c.endswith("timestamp") and d[c.split()[0]]
               else d[c.split()[0]] for c in cols) for d in data], ORDER)
    got = [r["error_description"] for r in silver.flag_orders(df).collect()]
    assert got == ["Invalid quantity", "Missing customer ID", "Invalid date order", "Valid"]
    assert "WHEN quantity IS NULL OR quantity < 0 THEN 'Invalid quantity'" in quality.rules_sql()


def test_oversized_tax_is_valid_and_becomes_null(spark):
    from datetime import datetime
    df = spark.createDataFrame([("1", 1, datetime(2024, 1, 1, 10), datetime(2024, 1, 2), "A", 1,
                                 2.5, 1234.5, 1, 1, "s", "w")], ORDER)
    out = silver.flag_orders(df).first()
    assert out["error_description"] == "Valid" and out["taxamount"] is None
    assert str(out["createddate"]) == "2024-01-01", "merge keys compare dates, not timestamps"


def test_delivery_status_and_on_time_share(spark):
    ship = spark.createDataFrame([
        ("a", "o1", "2024-01-01", "2024-01-05", "2024-01-06", "s1", Decimal("1.00")),
        ("b", "o2", "2024-01-01", "2024-01-05", "2024-01-04", "s1", Decimal("1.00")),
        ("c", "o3", "2024-01-01", "2024-01-05", None, "s1", Decimal("1.00")),
    ], "shipment_id string, salesordernumber string, shipment_date string, "
       "expected_delivery_date string, actual_delivery_date string, supplier_id string, "
       "shipping_cost decimal(18,2)")
    for c in ("carrier_name", "delivery_location", "product_id", "promised_delivery_date",
              "purchase_order_id", "delivery_status"):
        ship = ship.withColumn(c, ship.shipment_id.substr(0, 0))
    ship = ship.withColumn("quantity_shipped", ship.shipping_cost.cast("bigint"))
    fact = silver.fact_shipments(ship)
    status = {r["shipment_id"]: r["delivery_status"] for r in fact.collect()}
    assert status == {"a": "Delayed", "b": "On Time", "c": "On Time"}, "undelivered is On Time"
    s = silver.Silver(None, None, fact, None, None, None, None)
    perf = gold.supplier_delivery_performance(s, "2024-02-01").first()
    assert (perf["total_shipments"], perf["delayed_shipments"], perf["on_time_pct"]) == (3, 1, 33.33)


def test_inferred_csv(spark, workdir):
    path = f"{workdir}/x.csv"
    with open(path, "w") as fh:
        fh.write("a,b\n1,x\n2,y\n")
    df = files.read_csv_inferred(spark, path)
    assert dict(df.dtypes) == {"a": "int", "b": "string"}
    assert rows(df) == [(1, "x"), (2, "y")]


def test_scd2_dimension_joins_current_version_unless_all(spark):
    from decimal import Decimal as D
    fact = spark.createDataFrame(
        [("o1", 1, 2, D("10.0000"))],
        "salesordernumber string, customer_id int, quantity int, unitprice decimal(8,4)")
    dim = spark.createDataFrame(
        [(1, "OLDLAND", False), (1, "NEWLAND", True)],
        "customer_id int, country string, is_current boolean")
    suppliers = spark.createDataFrame([], "supplier_id string, is_current boolean")
    s = silver.Silver(fact, None, None, dim, None, suppliers, None)
    current = {r["country"]: r["total_sales_amount"]
               for r in gold.sales_by_country(s, "2024-01-01 00:00:00").collect()}
    assert current == {"NEWLAND": D("20.00")}
    every = {r["country"]: r["total_sales_amount"]
             for r in gold.sales_by_country(s, "2024-01-01 00:00:00", dims="all").collect()}
    assert every == {"NEWLAND": D("20.00"), "OLDLAND": D("20.00")}, "one sale per version"
