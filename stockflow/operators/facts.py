"""Fact tables: orders and daily inventory snapshots.

Business rules applied once, at load:

* ``revenue`` = 0 for a cancelled order, else ``total_amount``; a NULL status
  is not cancelled and keeps its amount.
* ``avg_daily_demand`` = all units ordered (every status, every warehouse)
  ÷ ``horizon_days``; a product never ordered gets ``default_demand`` (1).
* ``days_of_supply`` = stock ÷ demand, half-even to 1 dp, capped at
  ``supply_cap``; stock > 0 over zero demand is the cap, 0 over 0 is NULL.
* ``stockout_flag`` = 1 when stock is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.calendar import date_key
from stockflow.functions.numeric import MONEY, round_half_even
from stockflow.operators.days import Days

# Fact layouts, the days-of-supply cap and the default demand of a
# never-ordered product, as the reference defines them.
SUPPLY_CAP, DEFAULT_DEMAND = 999.0, 1.0
FACT_ORDER_COLUMNS = ["order_id", "date_id", "product_id", "warehouse_id", "quantity", "unit_price",
                      "total_amount", "revenue", "shipping_method", "status", "customer_city",
                      "customer_state"]
FACT_INVENTORY_COLUMNS = ["inventory_id", "date_id", "product_id", "warehouse_id", "stock_level",
                          "restock_qty", "days_of_supply", "stockout_flag"]


def fact_orders(raw_orders: DataFrame, cancelled: str = "Cancelled") -> DataFrame:
    """One row per order line; a narrow projection (no shuffle)."""
    revenue = (F.when(F.col("status") == cancelled, F.lit(0).cast(MONEY))
                .otherwise(F.col("total_amount").cast(MONEY)))
    return raw_orders.select(
        "order_id",
        date_key("order_date").alias("date_id"),
        "product_id", "warehouse_id",
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("unit_price").cast(MONEY).alias("unit_price"),
        F.col("total_amount").cast(MONEY).alias("total_amount"),
        revenue.alias("revenue"),
        "shipping_method", "status", "customer_city", "customer_state",
    )


def avg_daily_demand(raw_orders: DataFrame, horizon_days: int) -> DataFrame:
    """Units per day per product over the horizon (partial + final aggregate)."""
    return (raw_orders.groupBy("product_id")
                      .agg((F.sum("quantity").cast("double") / F.lit(float(horizon_days)))
                           .alias("avg_daily_demand")))


def with_demand(rows: DataFrame, demand: DataFrame) -> DataFrame:
    """Rows of any grain with their product's ``avg_daily_demand`` (one row per product;
    the planner broadcasts it by its actual size or joins by shuffle, splitting hot products)."""
    return rows.join(demand, "product_id", "left")


def fact_inventory(raw_inventory: DataFrame, demand: DataFrame, supply_cap: float = SUPPLY_CAP,
                   default_demand: float = DEFAULT_DEMAND) -> DataFrame:
    """Daily stock snapshots with days of supply and the stock-out flag."""
    return supply_columns(with_demand(raw_inventory, demand), supply_cap=supply_cap, default_demand=default_demand)


def supply_columns(inv: DataFrame, *more: str, supply_cap: float = SUPPLY_CAP,
                   default_demand: float = DEFAULT_DEMAND) -> DataFrame:
    """The fact of daily snapshots that have their ``avg_daily_demand``, and the columns ``more``."""
    dem = F.coalesce(F.col("avg_daily_demand"), F.lit(float(default_demand)))
    stock = F.col("stock_level").cast("double")
    ratio = F.try_divide(stock, F.nullif(dem, F.lit(0.0)))
    cap = F.lit(float(supply_cap))
    # min(round(x), cap) == round(min(x, cap)) for an integral cap; capping
    # first keeps the rounding on small numbers.
    dos = (F.when(dem == 0, F.when(stock > 0, cap))
            .otherwise(round_half_even(F.least(ratio, cap), 1)))
    return inv.select(
        "inventory_id",
        date_key("date").alias("date_id"),
        "product_id", "warehouse_id",
        F.col("stock_level").cast("bigint").alias("stock_level"),
        F.col("restock_qty").cast("bigint").alias("restock_qty"),
        dos.cast("double").alias("days_of_supply"),
        (F.col("stock_level") == 0).cast("int").alias("stockout_flag"),
        *more,
    )


def days_of_supply(stock: np.ndarray, known: np.ndarray | None, demand: np.ndarray, supply_cap: float = SUPPLY_CAP) -> tuple[np.ndarray, np.ndarray | None]:
    """The rule of :func:`supply_columns` on arrays of days: days of supply in tenths, and where they are
    known.  ``demand`` is a column, a product's for each row of days."""
    with np.errstate(divide="ignore", invalid="ignore"):
        supply = stock / demand
    if known is not None:
        supply[~known] = np.nan   # the least of this and the cap is the cap
    np.fmin(supply, supply_cap, out=supply)
    supply *= 10.0
    np.rint(supply, out=supply)
    supply /= 10.0    # rounded to one place as they are stored: whole tenths add up exactly
    supply *= 10.0
    np.rint(supply, out=supply)
    idle = demand[:, 0] == 0
    if not idle.any():
        return supply, None
    supply[idle] = np.rint(supply_cap * 10.0)
    given = np.ones(stock.shape, bool)
    given[idle] = stock[idle] > 0 if known is None else (stock[idle] > 0) & known[idle]
    return supply, given


def supply_sums(days: Days, default_demand: float = DEFAULT_DEMAND) -> dict[str, pa.Array]:
    """Stock-out days and days of supply of daily snapshots that have their ``avg_daily_demand``."""
    demand, known = days.pair("avg_daily_demand")
    if known is not None:
        demand = np.where(known, demand, default_demand)
    supply, given = days_of_supply(days.stock, days.stock_known, demand)
    tenths, empty = days.space(0), days.space(1)
    np.copyto(tenths, supply, casting="unsafe")
    np.equal(days.stock, 0, out=empty, casting="unsafe")
    tenth = lambda total: pc.divide(total.cast(pa.float64()), 10.0)
    return {"stockout_days": days.total(empty, days.stock_known),
            "days_of_supply": tenth(days.total(tenths, given)), "days_of_supply_by_day": tenth(days.by_day(tenths, given))}


SUPPLY_SUMS = "stockout_days bigint, days_of_supply double, days_of_supply_by_day double"
