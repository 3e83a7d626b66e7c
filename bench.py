"""Benchmark: prints one JSON line with per-query seconds.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Phase 1 builds the seven silver tables from the driver tables (quality
rules, de-duplication, dimension transforms) and stages them as Parquet, as
the pipeline's silver layer would hold them.  Phase 2 runs every gold report
over those tables.  Phase 3 runs every other registered query of the lakehouse
from the driver tables, file, publish and stream ones included.  Every query is
executed in full through the `noop` sink (no collect to the driver).  The
training-data operators are measured by the check tool (see README).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from quaylake.plans import gold, registry, silver
    from quaylake.session import local_session, scratch_path
    from quaylake.sinks.writers import Lakehouse

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="quaylake-bench")
    times: dict[str, float] = {}

    def run(name, build):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)

    # Warm-up (JIT, file listing cache); not timed.
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.format("noop").mode("overwrite").save()

    lake = Lakehouse(spark, scratch_path(spark, "bench", str(time.time_ns())))
    start = time.perf_counter()
    built = silver.from_driver(spark, sf_dir, registry.RUN_TS)
    staged = silver.Silver(**lake.stage_many(built.tables()))
    times["silver_build"] = round(time.perf_counter() - start, 3)

    s, rd, ts = staged, registry.RUN_DATE, registry.RUN_TS
    reports = {
        "sales_summary": lambda: gold.sales_summary(s),
        "sales_by_country": lambda: gold.sales_by_country(s, ts),
        "sales_by_supplier_daily": lambda: gold.sales_by_supplier_daily(s, ts),
        "sales_by_supplier_monthly": lambda: gold.sales_by_supplier_monthly(s, ts),
        "supply_chain_summary": lambda: gold.supply_chain_summary(s),
        "shipping_performance": lambda: gold.shipping_performance(s),
        "inventory_levels": lambda: gold.inventory_levels(s),
        "late_deliveries": lambda: gold.late_deliveries(s, rd),
        "overstock_inactive": lambda: gold.overstock_inactive(s, registry.IDLE_RUN_DATE),
        "high_shipping_orders": lambda: gold.high_shipping_orders(s, rd),
        "order_stock_shortage": lambda: gold.order_stock_shortage(s, rd),
        "supplier_delivery_performance": lambda: gold.supplier_delivery_performance(s, rd),
        "upcoming_stock_shortage": lambda: gold.upcoming_stock_shortage(s, rd),
        "order_lead_time": lambda: gold.order_lead_time(s, rd),
        "top_supplier_sales": lambda: gold.top_supplier_sales(gold.sales_by_supplier_daily(s, ts)),
    }
    for name, build in reports.items():
        run(name, build)

    for name, build in registry.QUERIES.items():
        if name not in times:
            run(name, lambda b=build: b(spark, sf_dir))

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
