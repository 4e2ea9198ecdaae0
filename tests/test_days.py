"""Sums of days made in arrays against the same sums of daily rows, and what the ledger shuffles."""

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockflow.operators import days, facts, ledger
from stockflow.plans import catalog
from stockflow.plans.warehouse import StarSchema, star_schema
from tests.conftest import SF0001

FIRST, LAST = "2019-11-20", "2021-02-10"


@pytest.fixture(scope="module")
def stretches(spark):
    """Pairs with few and many sales, a falling and an unknown restock, an unknown demand and none."""
    rng = random.Random(9)
    some = [(f"P{p}", w, rng.randrange(30), r, d) for p, (r, d) in enumerate([(2, 0.3), (0, 0.0), (-3, 7.1), (None, 0.01), (5, None), (1, -0.5)]) for w in ("W", None)]
    assortment = spark.createDataFrame(some, "product_id string, warehouse_id string, initial_stock long, restock_qty long, avg_daily_demand double")
    day0, n = date.fromisoformat(FIRST), (date.fromisoformat(LAST) - date.fromisoformat(FIRST)).days + 1
    sales = [(f"P{rng.randrange(7)}", rng.choice(["W", None]), str(day0 + timedelta(days=rng.randrange(n))), rng.randrange(1, 9)) for _ in range(400)]
    orders = spark.createDataFrame(sales, "product_id string, warehouse_id string, order_date string, quantity long")
    return ledger.stock_stretches(assortment, orders, FIRST, LAST, partitions=3, keep=["avg_daily_demand"]).checkpoint(eager=True)


def of_daily_rows(stretches):
    rows = facts.supply_columns(ledger.daily(stretches, FIRST))
    day, tenths = F.col("date_id") % 100, F.rint(F.col("days_of_supply") * 10).cast("bigint")
    sums = rows.groupBy("product_id", "warehouse_id", F.floor(F.col("date_id") / 100).cast("int").alias("month")).agg(
        F.count(F.lit(1)), F.min("date_id").alias("first_id"), F.max("date_id").alias("last_id"),
        F.sum("stock_level"), F.sum(F.col("stock_level") * day), F.min("stock_level"), F.sum("restock_qty"), F.sum(F.col("restock_qty") * day),
        F.sum("stockout_flag"), F.sum(tenths) / 10, F.sum(tenths * day) / 10)
    ids = {c: ledger.inventory_key("product_id", "warehouse_id", F.col(c)) for c in ("first_id", "last_id")}
    return sorted(map(tuple, sums.withColumns(ids).collect()), key=repr)


def of_arrays(stretches):
    both = lambda some: {**days.snapshot_sums(some), **facts.supply_sums(some)}
    keyed = stretches.withColumn("id_prefix", ledger.inventory_key("product_id", "warehouse_id", F.lit("")))
    rows = days.by_month(keyed, FIRST, both, f"{days.SNAPSHOT_SUMS}, {facts.SUPPLY_SUMS}").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("at_once", [1, 700, days.DAYS_AT_ONCE])
def test_sums_in_arrays_equal_those_of_daily_rows(stretches, monkeypatch, at_once):
    # Lots as they are cut in a task: by as few days as one pair's year, and by all.
    monkeypatch.setattr(days, "DAYS_AT_ONCE", at_once)
    rows = stretches.withColumn("__number", F.row_number().over(Window.partitionBy(*ledger.PAIR, "year").orderBy("i"))).sort(*ledger.PAIR, "i").toArrow()
    lots = [some.shape[0] for some in days._same_days(iter(rows.to_batches(max_chunksize=7)), days.Calendar(FIRST, 14))]
    assert sum(lots) == stretches.select(*ledger.PAIR, "year").distinct().count() and (at_once > 1 or set(lots) == {1})
    want = of_daily_rows(stretches)
    assert want == of_arrays(stretches) and len(want) == 12 * 16
    assert any(None in row[3:] for row in want)   # sums of nothing but unknown values are unknown


def test_unknown_stock_and_restock(spark):
    """Stretches may not know their stock, restock or rate; sums leave those days out."""
    rows = [("A", "W", 0, 12, None, 1, 2, 2020, 0.5), ("A", "W", 12, 40, 7, None, 2, 2020, 0.5), ("B", "W", 0, 40, 0, 0, 1, 2020, 0.0),
            ("C", "W", 0, 40, 3, 4, None, 2020, 1.0), ("D", "W", 0, 40, None, None, 0, 2020, None), ("E", "W", 0, 20, 5, 0, 1, 2020, 2.0), ("E", "W", 20, 40, 9, 0, 3, 2020, 2.0)]
    stretches = spark.createDataFrame(rows, "product_id string, warehouse_id string, i int, next_i int, stock_level long, restock long, rate long, year int, avg_daily_demand double")
    assert of_arrays(stretches) == of_daily_rows(stretches)


def test_missing_days_and_overflow_are_errors(spark):
    schema = "product_id long, warehouse_id long, i int, next_i int, stock_level long, restock long, rate long, year int, avg_daily_demand double"
    for rows, what in (([(1, 1, 0, 5, 1, 0, 0, 2020, 1.0), (1, 1, 6, 9, 1, 0, 0, 2020, 1.0)], "do not follow"), ([(1, 1, 0, 5, 2 ** 62, 0, 0, 2020, 1.0)], "64-bit")):
        with pytest.raises(Exception, match=what):
            of_arrays(spark.createDataFrame(rows, schema))


def test_a_day_has_no_row_and_events_are_dealt_once(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for name in ("stock_ledger", "fact_inventory", "inventory_numbers", "ledger_by_year", "ledger_extended"):
        text = plan(catalog.QUERIES[name](spark, SF0001))
        assert "explode(sequence" not in text and "MapInArrow" in text, name
        assert not re.search(r"hashpartitioning\([^)]*year", text), name   # the events and stretches lie by the pair
    ws = star_schema(spark, SF0001)
    dealt = [line for line in plan(ws.plan("supplied_stretches")).splitlines() if "Exchange" in line]
    assert sum("REPARTITION_BY_NUM" in line for line in dealt) == 1   # demand meets pairs, not stretches


def test_tasks_are_sized_by_events_too(spark):
    pairs = spark.createDataFrame([(1, 1)], "product_id long, warehouse_id long")
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ledger.pair_partitions(pairs, 100) == floor
    assert ledger.pair_partitions(pairs, 100, 50 * ledger.EVENTS_PER_PARTITION) == 51


def test_pairs_without_snapshots_have_no_number(spark, monkeypatch):
    class Few:
        name = "few pairs"

        def orders(self):
            return spark.createDataFrame([(p, 1, d, 1) for p in (1, 2, 3) for d in ("2020-01-01", "2020-02-10")], "product_id long, warehouse_id long, order_date string, quantity long")

        def assortment(self, orders):
            return spark.createDataFrame([(1, 1, 5, 1), (2, 1, None, 1), (3, 1, None, 2), (3, 1, 4, 3)], "product_id long, warehouse_id long, initial_stock long, restock_qty long")

    ws = StarSchema(spark, Few())
    monkeypatch.setattr(catalog, "_ws", lambda *_: ws)
    rows = sorted(tuple(r)[:6] for r in catalog.q_inventory_numbers(spark, "").collect())
    assert rows == [(1, 1, 202001, 31, 1, 31), (1, 1, 202002, 10, 32, 41), (3, 1, 202001, 31, 42, 72), (3, 1, 202002, 10, 73, 82)]
