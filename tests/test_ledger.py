"""Stock ledger: the closed form equals the clamped day-by-day loop."""

import random
from datetime import date, timedelta

from stockflow.operators.ledger import stock_ledger


def _loop(initial, restock, sold_by_day, days, every=14):
    stock, out = initial, []
    for i in range(days):
        r = restock if i % every == 0 else 0
        stock = max(0, stock - sold_by_day.get(i, 0) + r)
        out.append((stock, r))
    return out


def _run(spark, assortment, sales, start, days, partitions=None):
    a = spark.createDataFrame(assortment, "product_id string, warehouse_id string, initial_stock bigint, "
                                          "restock_qty bigint")
    o = spark.createDataFrame(sales, "product_id string, warehouse_id string, order_date date, quantity bigint")
    end = (start + timedelta(days=days - 1)).isoformat()
    return stock_ledger(a, o, start.isoformat(), end, partitions=partitions).collect()


def test_ledger_matches_loop_random(spark):
    rng = random.Random(7)
    start, days = date(2024, 1, 1), 120
    assortment, sales, expected = [], [], {}
    for p in range(6):
        for w in range(2):
            init, restock = rng.randint(0, 40), rng.randint(1, 30)
            assortment.append((f"P{p}", f"W{w}", init, restock))
            sold = {}
            for _ in range(rng.randint(0, 60)):
                i, q = rng.randrange(days), rng.randint(1, 25)
                sold[i] = sold.get(i, 0) + q
                sales.append((f"P{p}", f"W{w}", start + timedelta(days=i), q))
            for i, (s, r) in enumerate(_loop(init, restock, sold, days)):
                expected[(f"P{p}", f"W{w}", (start + timedelta(days=i)))] = (s, r)
    # sales outside the range are ignored
    sales.append(("P0", "W0", start - timedelta(days=1), 1000))
    rows = _run(spark, assortment, sales, start, days)
    assert len(rows) == len(expected)
    zeros = 0
    for r in rows:
        assert (r.stock_level, r.restock_qty) == expected[(r.product_id, r.warehouse_id, r.date)]
        assert r.stock_level >= 0
        zeros += r.stock_level == 0
    assert zeros > 0  # the clamp was exercised


def test_ledger_zero_repeated_oversell(spark):
    start = date(2024, 3, 1)
    sales = [("P", "W", start + timedelta(days=i), 50) for i in (1, 2, 15, 16, 29)]
    rows = sorted(_run(spark, [("P", "W", 10, 30)], sales, start, 35, partitions=3), key=lambda r: r.date)
    stock = [r.stock_level for r in rows]
    sold = {(d - start).days: 50 for (_, _, d, _) in sales}
    assert stock == [s for s, _ in _loop(10, 30, sold, 35)]
    assert stock[0] == 40 and stock[1] == 0 and stock[14] == 30 and stock[15] == 0
