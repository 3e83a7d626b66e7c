"""Refresh of the sales summaries (G1-G4) by changed groups.

Loads note what they changed in a table of changes: the days of the order rows they merged, and
the keys of the dimension rows they loaded.  A refresh takes the notes that no refresh has taken
yet and recomputes only the groups that such rows fall into: days, months, or countries, whole
groups each, so an order row whose supplier changed is counted out of its old group as well.
The reports are filtered on their group column; Catalyst pushes that filter through the
aggregate and the joins into the scan of the day-partitioned order fact, so days without a
change are not read (the summary by country reads the key columns of all days).  Groups that
are not touched keep their rows, their `last_updated` included.

The merge rewrites only the buckets of the summary that the groups lie in.  As in a merge of the
whole report, a group without any row left stays.  Notes count as taken after the merges: a
refresh that broke off is repeated whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.writers import Lakehouse
from . import gold
from .silver import Silver

GOLD_MERGES = {
    # table -> (function, keys, measures updated on a match)
    "gold.fact_sales_summary": (
        lambda s, d, t: gold.sales_summary(s),
        ["customer_name", "product_name", "supplier_name", "warehouse_name", "sale_date"],
        ["total_quantity_sold", "total_sales_amount", "total_tax_collected"]),
    "gold.fact_sales_summary_by_country": (
        lambda s, d, t: gold.sales_by_country(s, t), ["country"], None),
    "gold.fact_sales_summary_by_supplier_daily": (
        lambda s, d, t: gold.sales_by_supplier_daily(s, t), ["sales_date", "supplier_id"],
        ["total_sales_amount", "total_quantity_sold", "total_orders", "last_updated"]),
    "gold.fact_sales_summary_by_supplier_monthly": (
        lambda s, d, t: gold.sales_by_supplier_monthly(s, t), ["sales_month", "supplier_id"],
        ["total_sales_amount", "total_quantity_sold", "total_orders", "last_updated"]),
}
CHANGES, TAKEN = "silver.changes", "gold.refreshed_changes"
ORDERS = "fact_sales_order"
#: Dimensions whose values the summaries show, by the order fact's key.
DIMENSION_KEYS = {"dim_customer": "customer_id", "dim_product": "product_id",
                  "dim_supplier": "supplier_id", "dim_warehouse": "warehouse_id"}


def create(lake: Lakehouse) -> None:
    lake.create_table(CHANGES, "entry string, what string, value string", [])
    lake.create_table(TAKEN, "entry string", [])


def note(lake: Lakehouse, what: str, key: str, rows: DataFrame) -> None:
    """Note that a load changed `rows` of the table `what` (`ORDERS`: their days, a dimension: their keys).
    Called after the rows are merged and before the load counts as done."""
    create(lake)
    lake.append(CHANGES, rows.select(F.col(key).cast("string").alias("value")).distinct().select(
        F.lit(uuid.uuid4().hex).alias("entry"), F.lit(what).alias("what"), "value"))


def _among(column: str, values: list) -> Column:
    """Whether a column has one of the values, NULL included."""
    known = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
    return F.col(column).isNull() | known if None in values else known


def touched_days(s: Silver, changes: DataFrame) -> list[date | None]:
    """The days of changed order rows and of the order rows that show a changed dimension row.
    There are as many as days with orders at most."""
    kinds = {r["what"] for r in changes.select("what").distinct().collect()}
    days = changes.where(F.col("what") == ORDERS).select(F.col("value").cast("date").alias("createddate"))
    for what, key in DIMENSION_KEYS.items():
        if what in kinds:
            ids = changes.where(F.col("what") == what).select("value")
            f = s.fact_sales_order.select("createddate", F.col(key).cast("string").alias("value"))
            days = days.union(f.join(ids, "value", "left_semi").select("createddate"))
    return sorted((r["createddate"] for r in days.distinct().collect()), key=lambda d: (d is None, d or 0))


def touched_countries(s: Silver, changes: DataFrame) -> DataFrame:
    """The countries of customers with orders on changed days, and those that changed customers had
    in any version.  A customer without a current version counts under the NULL country."""
    days = [r["day"] for r in changes.where(F.col("what") == ORDERS)
            .select(F.col("value").cast("date").alias("day")).distinct().collect()]
    changed = changes.where(F.col("what") == "dim_customer").select(F.col("value").cast("int").alias("customer_id"))
    buyers = s.fact_sales_order.where(_among("createddate", days)).select("customer_id")
    versions = s.dim_customer.select("customer_id", "country", "is_current")
    current = versions.where("is_current").select("customer_id", "country")
    return (buyers.union(changed).distinct().join(current, "customer_id", "left").select("country")
            .union(changed.join(versions, "customer_id").select("country")).distinct())


def touched_reports(s: Silver, changes: DataFrame, run_date, run_ts,
                    tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The touched groups of each summary."""
    tables = list(GOLD_MERGES) if tables is None else tables
    days = touched_days(s, changes)
    months = sorted({None if d is None else f"{d:%Y-%m}" for d in days}, key=str)

    def by_country(report: DataFrame) -> DataFrame:
        found = touched_countries(s, changes).withColumnRenamed("country", "_country")
        return report.join(found, F.col("country").eqNullSafe(F.col("_country")), "left_semi")

    limits: dict[str, Callable[[DataFrame], DataFrame]] = {
        "gold.fact_sales_summary": lambda r: r.where(_among("sale_date", days)),
        "gold.fact_sales_summary_by_country": by_country,
        "gold.fact_sales_summary_by_supplier_daily": lambda r: r.where(_among("sales_date", days)),
        "gold.fact_sales_summary_by_supplier_monthly": lambda r: r.where(_among("sales_month", months)),
    }
    return {t: limits[t](GOLD_MERGES[t][0](s, run_date, run_ts)) for t in tables}


class Refresh:
    """One refresh: `merges` are independent writes; `done` is called when all have ended.

    Without any refresh before (or with `full`) the whole reports are merged."""

    def __init__(self, lake: Lakehouse, s: Silver, run_date, run_ts, tables: list[str] | None = None,
                 full: bool = False):
        create(lake)
        tables = list(GOLD_MERGES) if tables is None else tables
        self.lake, taken = lake, lake.table(TAKEN)
        # Staged: notes made while the refresh runs belong to the next one.
        self.changes = lake.stage(lake.table(CHANGES).join(taken, "entry", "left_anti"), "changes")
        if full or taken.isEmpty():
            reports = {t: GOLD_MERGES[t][0](s, run_date, run_ts) for t in tables}
        elif self.changes.isEmpty():
            reports = {}
        else:
            reports = touched_reports(s, self.changes, run_date, run_ts, tables)
        self.merges = [lambda t=t, r=r: lake.merge(t, r, GOLD_MERGES[t][1], update_cols=GOLD_MERGES[t][2],
                                                   null_safe_keys=True) for t, r in reports.items()]

    def done(self) -> None:
        self.lake.append(TAKEN, self.changes.select("entry").distinct())
