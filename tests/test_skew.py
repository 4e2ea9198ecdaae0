"""Hot keys: one product holds a third of all orders, one rank value a third
of all rows.  Results must stay exact, and aggregation must be partial
(map-side) before the shuffle."""

import contextlib
import io
import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockflow.operators.ledger import stock_ledger
from stockflow.operators.ranking import global_rank
from stockflow.plans import kpis
from tests.test_kpis import FO, PROD, SUP


def _skewed_orders(n=3000, seed=11):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        pid = "HOT" if i % 3 == 0 else f"P{rng.randrange(40):02d}"
        status = rng.choice(["Delivered", "Delivered", "Delayed", "Cancelled"])
        amount = Decimal(rng.randint(100, 99999)) / 100
        rev = Decimal("0.00") if status == "Cancelled" else amount
        rows.append((f"O{i}", 20240101 + rng.randrange(28), pid, "W1", rng.randint(1, 9), amount, amount, rev,
                     "Standard", status, "c", "s"))
    return rows


def test_hot_product_kpis_exact(spark):
    rows = _skewed_orders()
    fo = spark.createDataFrame(rows, FO)
    pids = sorted({r[2] for r in rows})
    prods = spark.createDataFrame([(p, f"n-{p}", "C", f"S{j % 4}", Decimal("1.00"), Decimal("2.00"), 5, 50.0)
                                   for j, p in enumerate(pids)], PROD)
    sups = spark.createDataFrame([(f"S{j}", f"s{j}", "X", 0.9, 5) for j in range(4)], SUP)

    # brute force, plain Python
    rev, units = defaultdict(Decimal), defaultdict(int)
    for r in rows:
        if r[9] != "Cancelled":
            rev[r[2]] += r[7]
            units[r[2]] += r[4]
    best = sorted(rev, key=lambda p: (-rev[p], p))[:10]
    out = kpis.top_products(fo, prods, sups, top=10).collect()
    assert [r.product_name for r in out] == [f"n-{p}" for p in best]
    assert out[0].product_name == "n-HOT" and out[0].units_sold == units["HOT"]
    assert [r.total_revenue for r in out] == [float(rev[p]) for p in best]

    sup_of = {p: f"S{j % 4}" for j, p in enumerate(pids)}
    total, delayed = defaultdict(int), defaultdict(int)
    for r in rows:
        total[sup_of[r[2]]] += 1
        delayed[sup_of[r[2]]] += r[9] == "Delayed"
    got = {r.supplier_id: (r.total_orders, r.delayed_orders) for r in
           kpis.supplier_scorecard(fo, prods, sups).collect()}
    assert got == {s: (total[s], delayed[s]) for s in total}


def test_kpi_plans_aggregate_before_shuffle(spark):
    fo = spark.createDataFrame(_skewed_orders(300), FO)
    wh = spark.createDataFrame([("W1", "w", "c", "s", 10)], "warehouse_id string, warehouse_name string, "
                                                           "city string, state string, capacity int")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        kpis.warehouse_performance(fo, wh).explain()
    plan = buf.getvalue()
    assert "partial_sum" in plan and "partial_count" in plan


def test_rank_with_a_hot_value(spark):
    rng = random.Random(5)
    rows = [(i, 0.0 if i % 3 == 0 else float(rng.randint(1, 30))) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, v double")
    ours = {r.id: r.rk for r in global_rank(df, [("v", True)], "rk", partitions=5).collect()}
    ref = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").desc()))).collect()}
    assert ours == ref


def test_ledger_hot_pair(spark):
    """One pair carries a third of all sales; the balance is still exact."""
    start, days = date(2024, 1, 1), 60
    rng = random.Random(9)
    assortment = [("HOT", "W1", 500, 200)] + [(f"P{i}", "W1", 50, 20) for i in range(10)]
    sales, sold = [], defaultdict(lambda: defaultdict(int))
    for k in range(600):
        pid = "HOT" if k % 3 == 0 else f"P{rng.randrange(10)}"
        i, q = rng.randrange(days), rng.randint(1, 20)
        sales.append((pid, "W1", start + timedelta(days=i), q))
        sold[pid][i] += q
    a = spark.createDataFrame(assortment, "product_id string, warehouse_id string, initial_stock bigint, "
                                          "restock_qty bigint")
    o = spark.createDataFrame(sales, "product_id string, warehouse_id string, order_date date, quantity bigint")
    got = {(r.product_id, (r.date - start).days): r.stock_level
           for r in stock_ledger(a, o, start.isoformat(), (start + timedelta(days=days - 1)).isoformat(),
                                 partitions=4).collect()}
    for pid, _, init, restock in assortment:
        stock = init
        for i in range(days):
            stock = max(0, stock - sold[pid][i] + (restock if i % 14 == 0 else 0))
            assert got[(pid, i)] == stock
