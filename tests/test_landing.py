"""Landed orders: the joins of the stand-in tables, with null and repeated keys."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from functools import partial

import pytest

from stockflow.operators import joins
from stockflow.sources import testdata

LINES = [(1, 10, 1, 3.0, "N"), (1, 11, 2, 2.5, "A"), (2, 10, 3, 7.0, "R"), (2, 10, 3, 7.0, "R"), (3, 12, 4, 1.0, None),
         (4, 99, 1, 5.0, "N"), (None, 10, 1, 5.0, "N"), (5, None, 1, 5.0, "N"), (6, 11, 1, None, "N"), (7, 10, 1, 4.0, "N")]
ORDERS = [(1, 100), (2, 101), (2, 101), (3, 100), (4, 100), (5, 100), (6, 101), (7, None), (None, 100), (8, 999)]
CUSTOMERS = [(100, 0), (101, 1), (101, 1), (None, 0)]
NATIONS, REGIONS = [(0, "N0", 0), (1, "N1", 1)], [(0, "R0"), (1, "R1")]
PARTS = [(10, 19.99), (11, 0.125), (12, None), (None, 1.0)]


def _stored(spark, folder):
    day = datetime(1996, 2, 29)
    for name, rows, schema in (
            ("lineitem", [(*r, day) for r in LINES], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp"),
            ("orders", ORDERS, "o_orderkey long, o_custkey long"), ("customer", CUSTOMERS, "c_custkey long, c_nationkey int"),
            ("nation", NATIONS, "n_nationkey int, n_name string, n_regionkey int"), ("region", REGIONS, "r_regionkey int, r_name string"),
            ("part", PARTS, "p_partkey long, p_retailprice double")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _brute():
    out = Counter()
    cents = lambda x: None if x is None else Decimal(str(x)).quantize(Decimal("0.01"), "ROUND_HALF_UP")
    for ok, pk, no, q, flag in LINES:
        for part, price in PARTS:
            for o, ck in ORDERS:
                for c, nk in CUSTOMERS:
                    if None in (ok, pk, ck) or (ok, pk, ck) != (o, part, c):
                        continue
                    whole = None if q is None else Decimal(str(q)).quantize(Decimal("1"), "ROUND_HALF_UP")
                    total = None if whole is None or price is None else whole * cents(price)
                    out[ok, date(1996, 2, 29), pk, nk, f"N{nk}", f"R{nk}", None if q is None else int(q), cents(price), total,
                        ("Standard", "Express", "Overnight")[no % 3], {"N": "Delivered", "A": "Delayed"}.get(flag, "Cancelled")] += 1
    return out


def test_orders_are_landed_by_one_deal_of_the_lines(spark, tmp_path):
    orders = testdata.raw_orders(spark, _stored(spark, tmp_path))
    assert Counter(tuple(r) for r in orders.collect()) == _brute()
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan   # the lines' deal, and none of them sorted
    bottom = plan[:plan.index("ShuffledHashJoin")]
    assert "Exchange hashpartitioning(l_" not in bottom and "SortMergeJoin" not in bottom


@pytest.mark.parametrize("most", [None, 0])
def test_no_task_sorts_lines_to_meet_many_parts(spark, tmp_path, monkeypatch, most):
    """As with larger tables: the planner broadcasts nothing by itself, and with 0 no side is small."""
    if most is not None:
        monkeypatch.setattr(testdata, "broadcast_or_hash", partial(joins.broadcast_or_hash, max_rows=most))
    folder = _stored(spark, tmp_path)
    spark.createDataFrame([(10, "B1"), (11, "B2"), (12, None), (None, "B3")], "p_partkey long, p_brand string").write.parquet(f"{folder}/b/part.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = testdata.raw_orders(spark, folder)
        brands = testdata.brand_orders(spark, f"{folder}/b", orders)
        for df, keys in ((orders, ("l_orderkey", "l_partkey", "o_custkey")), (brands, ("l_orderkey", "l_partkey", "product_id"))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert not [k for k in keys if f"Sort [{k}" in plan]
        assert Counter(tuple(r) for r in orders.collect()) == _brute()
        of = {10: "B1", 11: "B2", 12: None}
        want = Counter()
        for r, n in _brute().items():
            if r[2] in of:
                want[r[:2] + (of[r[2]],) + r[3:]] += n
        at = [brands.columns.index(c) for c in orders.columns]
        assert Counter(tuple(r[i] for i in at) for r in brands.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
