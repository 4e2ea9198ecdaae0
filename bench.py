"""Benchmark: warehouse build, the eight KPIs, validation and the forecast.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is executed in full (``noop`` sink: every row is produced, nothing
is collected to the driver).  The star schema is built once and materialised,
as a warehouse would be, and the KPIs read the stored tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockflow.plans import catalog  # noqa: E402
from stockflow.plans.forecast import demand_forecast  # noqa: E402
from stockflow.plans.warehouse import star_schema  # noqa: E402
from stockflow.session import get_session  # noqa: E402

BUILD = ["raw_orders", "dim_date", "dim_suppliers", "dim_products", "dim_warehouses",
         "fact_orders", "raw_inventory", "fact_inventory"]
QUERIES = ["kpi1_monthly_revenue", "kpi2_delivery_rate", "kpi3_supplier_scorecard",
           "kpi4_inventory_turnover", "kpi5_stockouts", "kpi6_category_quarterly", "kpi7_top_products",
           "kpi8_warehouse_performance", "v1_row_counts", "v2_revenue_by_year", "v3_revenue_by_category",
           "load_summary", "q4_share_pct", "daily_demand"]
FORECAST = ["model_metrics", "feature_importance", "forecast_90day", "forecast_monthly",
            "forecast_error_naive"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(cores=cpus)
    times: dict[str, float] = {}
    # Untimed JVM warm-up (class loading, codegen of a trivial plan); touches no input data.
    spark.range(1000).selectExpr("sum(id)").collect()

    ws = star_schema(spark, sf_dir)
    t0 = time.time()
    for name in BUILD:
        t = time.time()
        ws.table(name)
        times[f"build_{name}"] = round(time.time() - t, 3)
    times["warehouse_build"] = round(time.time() - t0, 3)

    for key in QUERIES:
        t = time.time()
        _run(catalog.QUERIES[key](spark, sf_dir))
        times[key] = round(time.time() - t, 3)

    fc = demand_forecast(spark, sf_dir)
    t = time.time()
    fc.features()
    times["demand_features"] = round(time.time() - t, 3)
    t = time.time()
    fc.model()
    times["forest_fit"] = round(time.time() - t, 3)
    for key in FORECAST:
        t = time.time()
        _run(catalog.QUERIES[key](spark, sf_dir))
        times[key] = round(time.time() - t, 3)

    total = sum(v for k, v in times.items() if not k.startswith("build_"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(total, 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
