"""The eight operational KPIs over the star schema.

Shape shared by all of them: aggregate the fact on its foreign key first
(partial aggregation before the shuffle, so a hot key is combined map-side),
then join the *aggregate* — at most one row per dimension member — to the
dimension.  No fact row is ever joined to a dimension; whether the
dimension is broadcast is the planner's choice by its stored size.

Semantics kept from the reference queries:

* KPI 1/2/3/6/8 count cancelled orders (their revenue is 0); KPI 4 and 7
  exclude them with ``status != 'Cancelled'`` (which also drops NULL status).
* Rates are ``count_if / count(*) * 100`` rounded half-up to 1 dp; money is
  summed exactly and shown with 2 dp.
* KPI 1's LAG runs over the already rounded monthly revenue.
* KPI 3 ranks the unrounded delay rate; KPI 7 ranks unrounded revenue.
* KPI 4 divides by the average stock *already rounded* to 1 dp and buckets
  the unrounded ratio; a NULL ratio is 'Overstocked'.
* KPI 6 pools quarters of every year; a missing quarter is 0.
* Ties under a LIMIT are broken by the entity key so results are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions.numeric import (MONEY, count_where, money_out, round_half_up,
                                         safe_ratio)
from stockflow.operators.ranking import global_rank

# Order status labels and the turnover thresholds of the
# reference's KPI definitions.
CANCELLED, DELIVERED, DELAYED = "Cancelled", "Delivered", "Delayed"
HEALTHY_TURNOVER, MONITOR_TURNOVER = 4.0, 2.0


def _status(s: str):
    return F.col("status") == s


def within(fact: DataFrame, days: DataFrame, year: str = "__year") -> DataFrame:
    """Rows of a fact stored by ``year`` on the calendar ``days`` (a filtered
    dim_date).  The join on (year, day) lets Spark read only those years' folders,
    whatever the filter on the calendar is."""
    wanted = days.select(F.col("year").alias("__wanted_year"), F.col("date_id").alias("__wanted_day"))
    same = (F.col(year) == F.col("__wanted_year")) & (F.col("date_id") == F.col("__wanted_day"))
    return fact.join(wanted, same, "left_semi").drop(year)


def monthly_revenue(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """KPI 1: revenue, orders and units per month with month-over-month change."""
    by_day = (fact_orders.groupBy("date_id")
              .agg(F.sum("revenue").alias("rev"), F.count("order_id").alias("n"),
                   F.sum("quantity").alias("units")))
    cal = dim_date.select("date_id", "year", "month", "month_name")
    monthly = (by_day.join(cal, "date_id")
               .groupBy("year", "month", "month_name")
               .agg(money_out(F.sum("rev")).alias("revenue"),
                    F.sum("n").cast("bigint").alias("total_orders"),
                    F.sum("units").cast("bigint").alias("units_sold")))
    return (add_mom_change(monthly)
            .select("year", "month", "month_name", "revenue", "total_orders", "units_sold",
                    "prev_month_revenue", "mom_pct_change")
            .orderBy("year", "month"))


def add_mom_change(monthly: DataFrame) -> DataFrame:
    """Previous month's (already rounded) revenue and the % change, 1 dp.

    One row per calendar month: bounded by the calendar, so a single ordered
    window over it is cheap."""
    w = Window.orderBy("year", "month")
    prev = F.lag("revenue", 1).over(w)
    return (monthly.withColumn("prev_month_revenue", prev)
            .withColumn("mom_pct_change",
                        round_half_up(F.try_divide(F.col("revenue") - F.col("prev_month_revenue"),
                                                   F.col("prev_month_revenue")) * 100, 1)))


def delivery_rate(fact_orders: DataFrame, dim_warehouses: DataFrame) -> DataFrame:
    """KPI 2: delivered / delayed / cancelled counts and on-time rate per warehouse."""
    by_wh = (fact_orders.groupBy("warehouse_id")
             .agg(F.count(F.lit(1)).alias("total_orders"),
                  count_where(_status(DELIVERED)).alias("delivered"),
                  count_where(_status(DELAYED)).alias("delayed"),
                  count_where(_status(CANCELLED)).alias("cancelled")))
    wh = dim_warehouses.select("warehouse_id", "warehouse_name", "city", "state")
    return (by_wh.join(wh, "warehouse_id")
            .select("warehouse_name", "city", "state", "total_orders", "delivered", "delayed", "cancelled",
                    round_half_up(F.col("delivered").cast("double") / F.col("total_orders").cast("double") * 100, 1)
                    .alias("on_time_rate_pct"))
            .orderBy(F.col("on_time_rate_pct").desc()))


def supplier_scorecard(fact_orders: DataFrame, dim_products: DataFrame,
                       dim_suppliers: DataFrame) -> DataFrame:
    """KPI 3: orders, delays and revenue per supplier, ranked by delay rate."""
    by_product = (fact_orders.groupBy("product_id")
                  .agg(F.count("order_id").alias("n_orders"), F.count(F.lit(1)).alias("n_rows"),
                       count_where(_status(DELAYED)).alias("delayed"), F.sum("revenue").alias("rev")))
    by_supplier = (by_product.join(dim_products.select("product_id", "supplier_id"), "product_id")
                   .groupBy("supplier_id")
                   .agg(F.sum("n_orders").cast("bigint").alias("total_orders"),
                        F.sum("n_rows").cast("bigint").alias("n_rows"),
                        F.sum("delayed").cast("bigint").alias("delayed_orders"),
                        F.sum("rev").alias("rev")))
    sup = dim_suppliers.select("supplier_id", "supplier_name", "country",
                               F.col("on_time_rate").alias("contracted_on_time_rate"),
                               "avg_lead_time_days")
    scored = (by_supplier.join(sup, "supplier_id")
              .withColumn("delay_rate", F.col("delayed_orders").cast("double") / F.col("n_rows").cast("double"))
              .checkpoint())   # one row per supplier, read twice below
    ranked = global_rank(scored, [("delay_rate", True)], "delay_rank")
    return (ranked.select("supplier_id", "supplier_name", "country", "contracted_on_time_rate",
                          "avg_lead_time_days", "total_orders", "delayed_orders",
                          round_half_up(F.col("delay_rate") * 100, 1).alias("actual_delay_rate_pct"),
                          money_out("rev").alias("total_revenue_supplied"),
                          "delay_rank")
            .orderBy("delay_rank", "supplier_id"))


def inventory_turnover(fact_orders: DataFrame, fact_inventory: DataFrame, dim_products: DataFrame,
                       dim_suppliers: DataFrame, healthy: float = HEALTHY_TURNOVER,
                       monitor: float = MONITOR_TURNOVER) -> DataFrame:
    """KPI 4: units sold ÷ average stock per product, bucketed by thresholds."""
    sales = (fact_orders.where(F.col("status") != CANCELLED)
             .groupBy("product_id").agg(F.sum("quantity").alias("total_units_sold")))
    stock = (fact_inventory.groupBy("product_id")
             .agg(round_half_up(F.avg("stock_level"), 1).alias("avg_stock_level")))
    units = F.coalesce(F.col("total_units_sold"), F.lit(0))
    turnover, status = turnover_columns(units, F.col("avg_stock_level"), healthy, monitor)
    return (dim_products.select("product_id", "product_name", "category", "supplier_id")
            .join(sales, "product_id", "left")
            .join(stock, "product_id", "left")
            .join(dim_suppliers.select("supplier_id", "supplier_name"), "supplier_id", "left")
            .select("product_name", "category", "supplier_name",
                    units.cast("bigint").alias("units_sold"),
                    F.coalesce(F.col("avg_stock_level"), F.lit(0.0)).alias("avg_stock"),
                    turnover.alias("inventory_turnover"),
                    status.alias("stock_status"))
            .orderBy(F.col("inventory_turnover").desc_nulls_last()))


def turnover_columns(units, avg_stock, healthy: float = HEALTHY_TURNOVER, monitor: float = MONITOR_TURNOVER):
    """(turnover rounded to 2 dp, status bucket) from units sold and the
    average stock already rounded to 1 dp; the bucket uses the unrounded
    ratio and a NULL ratio (no or zero stock) is 'Overstocked'."""
    ratio = safe_ratio(units, avg_stock)
    status = (F.when(ratio >= healthy, "Healthy").when(ratio >= monitor, "Monitor")
              .otherwise("Overstocked"))
    return round_half_up(ratio, 2), status


def stockouts(fact_inventory: DataFrame, dim_products: DataFrame, dim_warehouses: DataFrame,
              horizon_days: int, top: int = 20) -> DataFrame:
    """KPI 5: the ``top`` product × warehouse pairs with most stock-out days."""
    days = (fact_inventory.where(F.col("stockout_flag") == 1)
            .groupBy("product_id", "warehouse_id")
            .agg(F.count(F.lit(1)).alias("total_stockout_days"))
            .where(F.col("total_stockout_days") > 0))
    j = (days.join(dim_products.select("product_id", "product_name", "category"), "product_id")
         .join(dim_warehouses.select("warehouse_id", "warehouse_name", "city"),
               "warehouse_id"))
    return (j.orderBy(F.col("total_stockout_days").desc(), "product_id", "warehouse_id")
            .limit(top)
            .select("product_name", "category", "warehouse_name", "city", "total_stockout_days",
                    round_half_up(F.col("total_stockout_days").cast("double") * 100 / float(horizon_days), 1)
                    .alias("pct_days_out_of_stock")))


def category_quarterly(fact_orders: DataFrame, dim_products: DataFrame, dim_date: DataFrame) -> DataFrame:
    """KPI 6: revenue per category pivoted to quarters (years pooled)."""
    cal = dim_date.select("date_id", "quarter")
    by_pq = (fact_orders.select("date_id", "product_id", "revenue").join(cal, "date_id")
             .groupBy("product_id", "quarter").agg(F.sum("revenue").alias("rev")))
    zero = F.lit(0).cast(MONEY)
    aggs = [money_out(F.sum(F.when(F.col("quarter") == q, F.col("rev")).otherwise(zero))).alias(f"q{q}_revenue")
            for q in (1, 2, 3, 4)]
    return (by_pq.join(dim_products.select("product_id", "category"), "product_id")
            .groupBy("category")
            .agg(*aggs, money_out(F.sum("rev")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc()))


def top_products(fact_orders: DataFrame, dim_products: DataFrame, dim_suppliers: DataFrame,
                 top: int = 10) -> DataFrame:
    """KPI 7: the ``top`` products by revenue (cancelled orders excluded).

    RANK of a top row depends only on the rows above it, so the top-k is taken
    first (distributed TakeOrderedAndProject) and ranked afterwards over ``top``
    rows — no global sort of all products.
    """
    by_product = (fact_orders.where(F.col("status") != CANCELLED)
                  .groupBy("product_id")
                  .agg(F.sum("quantity").cast("bigint").alias("units_sold"), F.sum("revenue").alias("rev")))
    j = (by_product.join(dim_products.select("product_id", "product_name", "category", "supplier_id",
                                             "margin_pct"), "product_id")
         .join(dim_suppliers.select("supplier_id", "supplier_name"), "supplier_id"))
    best = j.orderBy(F.col("rev").desc(), "product_id").limit(top)
    w = Window.orderBy(F.col("rev").desc())   # at most ``top`` rows
    return (best.withColumn("revenue_rank", F.rank().over(w))
            .select("product_name", "category", "supplier_name", "units_sold",
                    money_out("rev").alias("total_revenue"),
                    round_half_up("margin_pct", 1).alias("margin_pct"),
                    "revenue_rank")
            .orderBy("revenue_rank"))


def warehouse_performance(fact_orders: DataFrame, dim_warehouses: DataFrame) -> DataFrame:
    """KPI 8: volume, value, delays, fulfilment and revenue per capacity unit."""
    by_wh = (fact_orders.groupBy("warehouse_id")
             .agg(F.count("order_id").alias("total_orders"), F.count(F.lit(1)).alias("n_rows"),
                  F.sum("quantity").cast("bigint").alias("total_units"),
                  F.sum("revenue").alias("rev"), F.count("revenue").alias("n_rev"),
                  count_where(_status(DELAYED)).alias("delayed_orders"),
                  count_where(_status(CANCELLED)).alias("cancelled_orders"),
                  count_where(_status(DELIVERED)).alias("delivered")))
    wh = dim_warehouses.select("warehouse_id", "warehouse_name", "city", "state", "capacity")
    rev = F.col("rev").cast("double")
    return (by_wh.join(wh, "warehouse_id")
            .select("warehouse_name", "city", "state", "capacity", "total_orders", "total_units",
                    money_out("rev").alias("total_revenue"),
                    round_half_up(rev / F.col("n_rev").cast("double"), 2).alias("avg_order_value"),
                    "delayed_orders", "cancelled_orders",
                    round_half_up(F.col("delivered").cast("double") / F.col("n_rows").cast("double") * 100, 1)
                    .alias("fulfillment_rate_pct"),
                    round_half_up(F.try_divide(rev, F.col("capacity").cast("double")), 2)
                    .alias("revenue_per_capacity_unit"))
            .orderBy(F.col("total_revenue").desc()))
