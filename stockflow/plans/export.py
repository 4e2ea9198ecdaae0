"""Files that the reports are exported to: eight KPI and four forecast CSVs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockflow.plans import kpis
from stockflow.plans.forecast import DemandForecast
from stockflow.plans.warehouse import StarSchema
from stockflow.sources.files import write_csv

# File names, and a measure of each to check a copy by.
KPI_MEASURES = {
    "kpi1_monthly_revenue": "revenue",
    "kpi2_delivery_rate": "delivered",
    "kpi3_supplier_scorecard": "total_revenue_supplied",
    "kpi4_inventory_turnover": "units_sold",
    "kpi5_stockouts": "total_stockout_days",
    "kpi6_category_quarterly": "total_revenue",
    "kpi7_top_products": "total_revenue",
    "kpi8_warehouse_performance": "total_revenue",
}


def kpi_frames(ws: StarSchema) -> dict[str, DataFrame]:
    fo, dd, dp = ws.table("fact_orders"), ws.table("dim_date"), ws.table("dim_products")
    ds, dw, fi = ws.table("dim_suppliers"), ws.table("dim_warehouses"), ws.table("fact_inventory")
    frames = (kpis.monthly_revenue(fo, dd), kpis.delivery_rate(fo, dw), kpis.supplier_scorecard(fo, dp, ds),
              kpis.inventory_turnover(fo, fi, dp, ds), kpis.stockouts(fi, dp, dw, ws.horizon_days),
              kpis.category_quarterly(fo, dp, dd), kpis.top_products(fo, dp, ds), kpis.warehouse_performance(fo, dw))
    return dict(zip(KPI_MEASURES, frames, strict=True))


def write_kpis(ws: StarSchema, folder: str) -> None:
    """Each KPI as a folder of CSV files.  Reports of one row per month,
    category, warehouse or top-k are put in one file; those that grow with
    products or suppliers are written by all tasks."""
    for name, df in kpi_frames(ws).items():
        write_csv(df, f"{folder}/{name}.csv", single=name.split("_")[0] not in ("kpi3", "kpi4"))


def write_forecast(fc: DemandForecast, folder: str) -> None:
    write_csv(fc.model_metrics(), f"{folder}/model_metrics.csv", single=True)
    write_csv(fc.feature_importance(), f"{folder}/feature_importance.csv", single=True)
    write_csv(fc.forecast(), f"{folder}/demand_forecast_90days.csv")
    write_csv(fc.monthly(), f"{folder}/forecast_monthly_summary.csv")
