"""Broadcasts only behind a size check; beyond it a shuffle join is planned."""

import contextlib
import io

import pytest

from stockflow.operators.joins import bounded_broadcast, broadcast_or_hash, hashed, row_width


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_broadcast_only_under_bounds(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # no planner broadcasts
    try:
        big = spark.range(2000).withColumnRenamed("id", "k")
        small = spark.range(50).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in _plan(big.join(bounded_broadcast(small, max_rows=100), "k"))
        assert "BroadcastHashJoin" not in _plan(big.join(bounded_broadcast(small, max_rows=10), "k"))
        # byte bound: 50 rows × row width over the limit -> no broadcast
        assert "BroadcastHashJoin" not in _plan(big.join(bounded_broadcast(small, max_bytes=50 * row_width(small) - 1), "k"))
        assert big.join(bounded_broadcast(small, max_rows=10), "k").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [1, 3, 500_000])
def test_hashed_side_meets_unsorted_rows_in_enough_partitions(spark, most):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([(k % 7 if k % 5 else None, k) for k in range(200)], "k long, v long")
        side = spark.createDataFrame([(k, f"n{k}") for k in (0, 1, 1, 2, 3, 4, 5, None, 9)], "s long, name string")   # 9 rows
        joined = rows.join(hashed(side, "s", most=most), rows.k == side.s)
        plan = _plan(joined)
        assert "ShuffledHashJoin" in plan and "Sort" not in plan
        shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(shuffles, -(-9 // most))
        assert plan.count(f", {wanted})") == 2   # both sides are dealt alike
        plain = rows.join(side, rows.k == side.s)
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))
        assert "BroadcastHashJoin" in _plan(rows.join(broadcast_or_hash(side, "s", max_rows=9), rows.k == side.s))
        assert "ShuffledHashJoin" in _plan(rows.join(broadcast_or_hash(side, "s", max_rows=8), rows.k == side.s))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
