"""Summarise the physical plans of the gold reports (over staged silver).

    python tools/plans.py [sf_dir] > PLANS.md

Per query: shuffles, join strategies, map-side top-1 nodes, aggregation
stages and the filters pushed into Parquet scans.  The plans are taken
before execution (AQE may still turn sort-merge joins into broadcasts or
split skewed partitions at run time).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summary(df) -> dict:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    text = out.getvalue()
    tree = text.split("\n\n")[0]
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if p})
    return {
        "shuffles": len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", tree)),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin", tree)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", tree)),
        "partial_top1": len(re.findall(r"WindowGroupLimit", tree)) // 2,
        "hash_aggregates": len(re.findall(r"HashAggregate", tree)),
        "pushed": "; ".join(p.replace("IsNotNull", "NotNull") for p in pushed)[:160],
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from quaylake.plans import gold, registry
    from quaylake.session import local_session

    spark = local_session()
    s = registry._staged_silver(spark, sf_dir)
    rd, ts = registry.RUN_DATE, registry.RUN_TS
    queries = {
        "sales_summary": gold.sales_summary(s),
        "sales_by_country": gold.sales_by_country(s, ts),
        "sales_by_supplier_daily": gold.sales_by_supplier_daily(s, ts),
        "sales_by_supplier_monthly": gold.sales_by_supplier_monthly(s, ts),
        "supply_chain_summary": gold.supply_chain_summary(s),
        "shipping_performance": gold.shipping_performance(s),
        "inventory_levels": gold.inventory_levels(s),
        "late_deliveries": gold.late_deliveries(s, rd),
        "overstock_inactive": gold.overstock_inactive(s, registry.IDLE_RUN_DATE),
        "high_shipping_orders": gold.high_shipping_orders(s, rd),
        "order_stock_shortage": gold.order_stock_shortage(s, rd),
        "supplier_delivery_performance": gold.supplier_delivery_performance(s, rd),
        "upcoming_stock_shortage": gold.upcoming_stock_shortage(s, rd),
        "order_lead_time": gold.order_lead_time(s, rd),
        "top_supplier_sales": gold.top_supplier_sales(gold.sales_by_supplier_daily(s, ts)),
    }
    print(f"# Gold report plans over staged silver ({os.path.basename(sf_dir)})\n")
    print("| query | shuffles | broadcast joins | sort-merge joins | map-side top-1 | "
          "hash aggregates | filters pushed to Parquet |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, df in queries.items():
        r = summary(df)
        print(f"| {name} | {r['shuffles']} | {r['broadcast_joins']} | {r['sort_merge_joins']} | "
              f"{r['partial_top1']} | {r['hash_aggregates']} | {r['pushed']} |")
    spark.stop()


if __name__ == "__main__":
    main()
