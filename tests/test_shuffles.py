"""How often the steps of the large queries move their rows (with joins that are not broadcast)."""

import contextlib

import pytest

from conftest import SF001, rows
from quaylake.operators.dedup import keep_one
from quaylake.operators.merge import DUPLICATE_ERROR, upsert
from quaylake.plans import gold, registry, silver


@contextlib.contextmanager
def unbroadcast(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1] for line in text.splitlines() if "Exchange hashpartitioning(" in line]


KEYED = "day date, k string, v int"


def test_null_safe_upsert_shuffles_each_side_once(spark, workdir):
    spark.sql("select date'2024-01-01' day, cast(id as string) k, 1 v from range(9)").write.parquet(f"{workdir}/t")
    spark.sql("select date'2024-01-01' day, cast(id as string) k, 2 v from range(5, 12)").write.parquet(f"{workdir}/s")
    t, s = spark.read.parquet(f"{workdir}/t"), spark.read.parquet(f"{workdir}/s")
    with unbroadcast(spark):
        merged = upsert(t, s, ["day", "k"], null_safe_keys=True)
        assert len(exchanges(merged)) == 2
        assert merged.count() == 12


def test_null_safe_keys_are_told_from_their_stand_ins(spark):
    # NULL is neither the first day of 1970 nor the text 0.
    target = spark.sql("select * from values (null, '0', 1), (date'1970-01-01', '0', 2), (date'1970-01-01', null, 3), "
                       "(null, null, 4) as t(day, k, v)").to(spark.createDataFrame([], KEYED).schema)
    source = spark.sql("select * from values (null, '0', 10), (date'1970-01-01', null, 30), (null, 'x', 50) as t(day, k, v)")
    got = upsert(target, source, ["day", "k"], null_safe_keys=True).selectExpr("string(day)", "k", "v")
    assert rows(got) == rows(spark.createDataFrame(
        [(None, "0", 10), ("1970-01-01", "0", 2), ("1970-01-01", None, 30), (None, None, 4), (None, "x", 50)],
        "day string, k string, v int"))
    with pytest.raises(Exception, match=DUPLICATE_ERROR + "NULL,x"):
        upsert(got, source.where("k = 'x'").union(source.where("k = 'x'")).union(
            source.where("k = 'x'")).selectExpr("string(day) day", "k", "v"), ["day", "k"], null_safe_keys=True).collect()


def test_lines_are_shuffled_once_for_products_and_stock(spark):
    s = registry._staged_silver(spark, SF001)
    with unbroadcast(spark):
        text = gold.supply_chain_summary(s)._jdf.queryExecution().executedPlan().toString()
    # The stock's text key is met by the products, not by the lines.
    below = text.split("Exchange hashpartitioning(cast(product_id")
    assert len(below) == 2
    assert "product_name" in below[1].split("FileScan parquet [")[1].split("]")[0]


def test_supplier_sums_shuffle_the_lines_once(spark):
    s = registry._staged_silver(spark, SF001, names=["fact_sales_order", "dim_supplier"])
    with unbroadcast(spark):
        found = exchanges(gold.sales_by_supplier_daily(s, registry.RUN_TS))
    assert len([x for x in found if x.startswith("sales_date")]) == 1
    assert len(found) == 3      # both sides of the join with the suppliers; the groups


def test_loads_of_the_wide_summary_share_their_lines(spark):
    s = registry._staged_silver(spark, SF001)
    lines = gold.supply_chain_lines(s)
    earlier = silver.Silver(**{**s.tables(), "fact_sales_order": registry._before(
        s.fact_sales_order, "createddate", registry.LOAD_CUTOFF)})
    for part, load in ((registry._before(lines, "createddate", registry.LOAD_CUTOFF), earlier), (lines, s)):
        got = rows(gold.one_per_order(part, s.fact_shipments))
        assert got and got == rows(gold.supply_chain_summary(load))


def _some_dims(s):
    """Silver where some lines miss a dimension, and some dimension rows have no name."""
    return silver.Silver(**{
        **s.tables(), "dim_customer": s.dim_customer.where("customer_id % 5 <> 1").selectExpr(
            *[c for c in s.dim_customer.columns if c != "customer_name"],
            "if(customer_id % 5 = 2, null, customer_name) customer_name").select(*s.dim_customer.columns),
        "dim_product": s.dim_product.where("product_id % 7 <> 3"),
        "dim_supplier": s.dim_supplier.where("supplier_id <> '4'"),
        "dim_warehouse": s.dim_warehouse.where("warehouse_id <> '2'")})


def test_wide_reports_share_the_lines_joined_with_dimensions(spark):
    s = registry._staged_silver(spark, SF001)
    for case in (s, _some_dims(s)):
        lines = gold.named_lines(case)
        for report in (gold.sales_summary, gold.supply_chain_summary):
            got = report(case, lines=lines)
            assert got.dtypes == report(case).dtypes
            assert rows(got) and rows(got) == rows(report(case))


def test_reports_of_an_audit_do_not_shuffle_lines_for_dimensions(spark):
    s = registry._staged_silver(spark, SF001)
    lines = registry._lake(spark, "lines").stage(gold.named_lines(s))
    with unbroadcast(spark):
        found = registry.gold_tables(s, lines=lines)
        assert len(exchanges(found["fact_sales_summary"])) == 1         # the groups
        assert len(exchanges(found["fact_supply_chain_summary"])) == 2  # the orders: lines and shipments


def test_shipping_costs_shuffle_the_shipments_once(spark):
    s = registry._staged_silver(spark, SF001, names=["fact_shipments"])
    with unbroadcast(spark):
        assert len(exchanges(gold.high_shipping_orders(s, registry.RUN_DATE))) == 1


def test_rows_are_cut_to_the_columns_that_decide(spark):
    """Ties in every column but the last, NULLs among them: the same values as of the whole rows."""
    rnd = spark.sql("""select int(hash(id, 1) % 7) k, if(id % 5 = 0, null, int(hash(id, 2) % 3)) t, int(hash(id, 3) % 2) a,
                       if(id % 11 = 0, null, int(hash(id, 4) % 2)) b, int(hash(id, 5) % 2) c from range(400)""").localCheckpoint()
    for wanted in (["k"], ["k", "t"], ["b", "k"], ["k", "c", "a"]):
        whole = keep_one(rnd, ["k"], ["t DESC"]).select(*wanted)
        cut = keep_one(rnd, ["k"], ["t DESC"], columns=wanted)
        assert cut.columns == wanted and rows(cut) == rows(whole)


def test_the_wide_summary_shuffles_no_more_of_shipments_than_it_needs(spark):
    for build in (registry._silver, registry._many_warehouses):
        whole, cut = build(spark, SF001), build(spark, SF001, gold.SUPPLY_CHAIN_FACTS)
        for name, columns in gold.SUPPLY_CHAIN_FACTS.items():
            assert rows(getattr(cut, name)) == rows(getattr(whole, name).select(*columns))
    for name in ("supply_chain_summary", "supply_chain_summary_warehouses"):
        plan = registry.QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert "shipping_cost" not in plan and "unit_cost" not in plan
