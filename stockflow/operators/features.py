"""Demand history and its lag / rolling / label features.

* ``daily_demand``     — units per product per selling day (non-cancelled),
  with calendar and product attributes.  Pre-aggregated on (date_id,
  product_id) before the calendar and product joins.
* ``demand_features``  — row-based lags and full-window trailing means per
  product (days without sales have no row, so lags count selling days, not
  calendar days); ordinal encodings of product and category fitted on every
  product *before* rows lacking a full history are dropped.
* ``share_cutoff``     — the first day before which a given share of the rows lies.
* ``time_split``       — train (< cutoff) / test (>= cutoff).

Every window is partitioned by product and holds at most one row per day of
the calendar, so no window partition can grow with the order volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.operators.ranking import ordinal_encode

# Feature list and target of the reference's model, in order.
FEATURES = ["month", "quarter", "week_number", "day_of_week", "is_weekend",
            "product_enc", "category_enc", "base_demand",
            "lag_7", "lag_14", "lag_30", "rolling_7", "rolling_30"]
TARGET = "units_sold"
LAGS = (7, 14, 30)
WINDOWS = (7, 30)
# Fixed value: share of the feature rows before the reference's cutoff (18,952 of 22,464), in percent.
TRAIN_PERCENT = 84

# Output layout of the daily demand.
DAILY_COLUMNS = ["full_date", "year", "month", "quarter", "week_number", "day_of_week", "is_weekend",
                 "product_id", "category", "base_demand", "units_sold"]


def daily_demand(fact_orders: DataFrame, dim_date: DataFrame, dim_products: DataFrame,
                 cancelled: str = "Cancelled") -> DataFrame:
    by_day = (fact_orders.where(F.col("status") != cancelled)
              .groupBy("date_id", "product_id")
              .agg(F.sum("quantity").cast("bigint").alias("units_sold")))
    cal = dim_date.select("date_id", "full_date", "year", "month", "quarter", "week_number", "day_of_week", "is_weekend")
    prod = dim_products.select("product_id", "category", "base_demand")
    return by_day.join(cal, "date_id").join(prod, "product_id").select(*DAILY_COLUMNS)


def label_encoders(daily: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(product_id → product_enc, category → category_enc) lookup tables."""
    return (ordinal_encode(daily, "product_id", "product_enc"),
            ordinal_encode(daily, "category", "category_enc"))


def demand_features(daily: DataFrame, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS,
                    encoders: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    w = Window.partitionBy("product_id").orderBy("full_date")
    cols = [F.lag("units_sold", k).over(w).alias(f"lag_{k}") for k in lags]
    for k in windows:
        frame = w.rowsBetween(-k, -1)
        cols.append(F.when(F.count("units_sold").over(frame) == k, F.avg("units_sold").over(frame))
                    .alias(f"rolling_{k}"))
    feats = daily.select(*daily.columns, *cols)
    prod_enc, cat_enc = encoders or label_encoders(daily)
    feats = feats.join(prod_enc, "product_id", "left").join(cat_enc, "category", "left")
    required = [f"lag_{k}" for k in lags] + [f"rolling_{k}" for k in windows]
    return feats.dropna(subset=required).select(*DAILY_COLUMNS, *required, "product_enc", "category_enc")


def share_cutoff(df: DataFrame, col: str, percent: int = TRAIN_PERCENT) -> str | None:
    """First day that has at least ``percent`` of all rows before it, or the last day
    if none has (a null table: null).  Rows are counted per day first, so the
    ordered window holds the calendar's days only."""
    days = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    ordered = Window.orderBy(col)   # a row for each day
    days = days.select(col, (F.sum("n").over(ordered) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"))
    first, last = days.agg(F.min(F.when(F.col("before") * 100 >= F.col("total") * percent, F.col(col))), F.max(col)).first()
    return first if first is not None else last


def time_split(df: DataFrame, col: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(col) < F.lit(cutoff)), df.where(F.col(col) >= F.lit(cutoff))
