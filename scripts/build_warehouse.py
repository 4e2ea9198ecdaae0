"""Build the star schema from five CSV files and export the reports.

Usage: python scripts/build_warehouse.py CSV_FOLDER OUT_FOLDER [--forecast CUTOFF]

CSV_FOLDER holds suppliers.csv, products.csv, warehouses.csv, orders.csv and
inventory.csv.  OUT_FOLDER gets warehouse/ (parquet), analytics/ (eight KPIs) and,
with --forecast, forecasts/ (four files; CUTOFF is the first test day).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockflow.plans import export  # noqa: E402
from stockflow.plans.forecast import DemandForecast  # noqa: E402
from stockflow.plans.warehouse import TABLES, StarSchema  # noqa: E402
from stockflow.session import get_session  # noqa: E402
from stockflow.sources.files import CsvFolder, write_table  # noqa: E402


def build(spark, csv_folder: str, out: str, cutoff: str | None = None) -> None:
    ws = StarSchema(spark, CsvFolder(spark, csv_folder))
    for name in TABLES:
        if not name.startswith("raw_"):
            write_table(ws.table(name), f"{out}/warehouse/{name}")
    export.write_kpis(ws, f"{out}/analytics")
    if cutoff:
        export.write_forecast(DemandForecast.from_schema(ws, cutoff=cutoff), f"{out}/forecasts")


if __name__ == "__main__":
    args = sys.argv[1:]
    if len(args) not in (2, 4) or (len(args) == 4 and args[2] != "--forecast"):
        sys.exit(__doc__)
    build(get_session(), args[0], args[1], args[3] if len(args) == 4 else None)
