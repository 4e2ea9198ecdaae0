"""Dimension tables of the star schema.

* ``date_dimension``      — one row per day of the data's range (bounded, so it
  is generated in a single small task).
* ``product_dimension``   — raw products + ``margin_pct`` (half-even, 2 dp).
* ``supplier_dimension`` / ``warehouse_dimension`` — conformed
  pass-through; required columns must be there, others are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.calendar import calendar_attributes, days_between
from stockflow.functions.numeric import round_half_even, safe_ratio

# The dimensions' columns, in order.
SUPPLIER_COLUMNS = ["supplier_id", "supplier_name", "country", "contact_email", "on_time_rate", "avg_lead_time_days"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "supplier_id", "unit_cost",
                   "unit_price", "base_demand"]
WAREHOUSE_COLUMNS = ["warehouse_id", "warehouse_name", "city", "state", "capacity"]
DATE_COLUMNS = ["date_id", "full_date", "year", "quarter", "month", "month_name", "week_number",
                "day_of_week", "day_name", "is_weekend", "is_month_end"]


def date_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar ``start``..``end`` inclusive with the eleven ``dim_date``
    attributes (``%W`` week numbers, Monday = 0, 0/1 flags)."""
    days = spark.range(1).select(F.explode(days_between(start, end)).alias("d"))
    return days.select(*[c.alias(name) for name, c in calendar_attributes("d").items()])


def product_dimension(raw_products: DataFrame) -> DataFrame:
    """Products plus ``margin_pct = round((price - cost) / price * 100, 2)``
    with pandas' half-even rounding; a zero price gives NULL."""
    p = raw_products
    margin = safe_ratio(F.col("unit_price") - F.col("unit_cost"), F.col("unit_price")) * 100
    return p.select(*_with_extra(p, PRODUCT_COLUMNS), round_half_even(margin, 2).alias("margin_pct"))


def supplier_dimension(raw_suppliers: DataFrame) -> DataFrame:
    return raw_suppliers.select(*_with_extra(raw_suppliers, SUPPLIER_COLUMNS))


def warehouse_dimension(raw_warehouses: DataFrame) -> DataFrame:
    return raw_warehouses.select(*_with_extra(raw_warehouses, WAREHOUSE_COLUMNS))


def _with_extra(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns first (a missing one is an error), others after them."""
    return [*required, *[c for c in df.columns if c not in required]]
