"""Identities of the reference's published results, recomputed with our
operators from the published base columns (rows copied as literals)."""

from pyspark.sql import functions as F

from stockflow.functions import round_half_up
from stockflow.operators.ranking import global_rank
from stockflow.plans.kpis import add_mom_change, delivery_rate, turnover_columns

# Published KPI 1 rows (year, month, revenue) and the expected lag / MoM %.
KPI1 = [(2023, 1, 1006522.9, None, None), (2023, 2, 1010276.97, 1006522.9, 0.4),
        (2023, 3, 1600137.96, 1010276.97, 58.4), (2023, 4, 1810741.52, 1600137.96, 13.2)]

# Published KPI 3 rows: (supplier, total_orders, delayed_orders, rate %, rank).
KPI3 = [("SUP004", 8668, 907, 10.5, 1), ("SUP005", 4367, 455, 10.4, 2), ("SUP006", 7145, 737, 10.3, 3),
        ("SUP007", 6087, 621, 10.2, 4), ("SUP003", 2646, 261, 9.9, 5), ("SUP008", 2687, 264, 9.8, 6),
        ("SUP002", 6245, 613, 9.8, 7), ("SUP001", 6261, 585, 9.3, 8)]

# Published KPI 4 rows: (units_sold, avg_stock, turnover, status).
KPI4 = [(13300, 5357.7, 2.48, "Monitor"), (13267, 5679.9, 2.34, "Monitor"), (12262, 5445.5, 2.25, "Monitor")]

# Published KPI 2 rows: (total, delivered, on_time_rate_pct).
KPI2 = [(14800, 12595, 85.1), (14601, 12397, 84.9), (14705, 12427, 84.5)]


def test_kpi1_lag_and_mom(spark):
    df = spark.createDataFrame([(y, m, r) for y, m, r, _, _ in KPI1], "year int, month int, revenue double")
    got = [(r.prev_month_revenue, r.mom_pct_change) for r in add_mom_change(df).orderBy("year", "month").collect()]
    assert got == [(p, m) for _, _, _, p, m in KPI1]


def test_kpi3_rate_and_rank(spark):
    df = spark.createDataFrame([(s, t, d) for s, t, d, _, _ in KPI3], "s string, t bigint, d bigint")
    df = df.withColumn("rate", F.col("d").cast("double") / F.col("t").cast("double"))
    out = global_rank(df, [("rate", True)], "rk").select(
        "s", "rk", round_half_up(F.col("rate") * 100, 1).alias("pct")).collect()
    assert {r.s: (r.pct, r.rk) for r in out} == {s: (p, k) for s, _, _, p, k in KPI3}


def test_kpi4_turnover_and_status(spark):
    df = spark.createDataFrame([(u, a) for u, a, _, _ in KPI4], "u bigint, a double")
    t, s = turnover_columns(F.col("u"), F.col("a"))
    assert [(r.t, r.s) for r in df.select(t.alias("t"), s.alias("s")).collect()] == [(t, s) for _, _, t, s in KPI4]


def test_kpi2_rate(spark):
    rows = []
    for i, (total, delivered, _) in enumerate(KPI2):
        rows += [(i, "Delivered")] * delivered + [(i, "Delayed")] * (total - delivered)
    df = spark.createDataFrame(rows, "warehouse_id int, status string")
    wh = spark.createDataFrame([(i, f"w{i}", "c", "s") for i in range(len(KPI2))],
                               "warehouse_id int, warehouse_name string, city string, state string")
    got = {int(r.warehouse_name[1:]): r.on_time_rate_pct for r in delivery_rate(df, wh).collect()}
    assert got == {i: p for i, (_, _, p) in enumerate(KPI2)}
