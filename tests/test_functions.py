"""Calendar attributes (``%W`` weeks, Monday = 0) and the rounding modes."""

from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import numpy as np

from pyspark.sql import functions as F

from stockflow.functions import calendar_attributes, round_half_even, round_half_up
from stockflow.operators.dims import DATE_COLUMNS, date_dimension


def test_calendar_matches_python_strftime(spark):
    start, end = date(1995, 1, 1), date(2025, 12, 31)
    dim = date_dimension(spark, start.isoformat(), end.isoformat())
    assert dim.columns == DATE_COLUMNS
    rows = {r.full_date: r for r in dim.collect()}
    assert len(rows) == (end - start).days + 1
    d = start
    while d <= end:
        r = rows[d.isoformat()]
        assert r.date_id == int(d.strftime("%Y%m%d"))
        assert r.week_number == int(d.strftime("%W"))
        assert r.day_of_week == d.weekday()
        assert r.month_name == d.strftime("%B") and r.day_name == d.strftime("%A")
        assert r.quarter == (d.month - 1) // 3 + 1
        assert r.is_weekend == (1 if d.weekday() >= 5 else 0)
        assert r.is_month_end == (1 if (d + timedelta(days=1)).month != d.month else 0)
        d += timedelta(days=1)


def test_calendar_edges(spark):
    """2023-01-01 is week 0; 2024-12-30/31 are week 53 (not ISO weeks)."""
    df = spark.createDataFrame([("2023-01-01",), ("2024-02-29",), ("2024-12-30",), ("2024-12-31",)], "s string")
    cal = calendar_attributes(F.to_date("s"))
    got = {r.s: (r.w, r.dow, r.me) for r in df.select("s", cal["week_number"].alias("w"),
                                                     cal["day_of_week"].alias("dow"),
                                                     cal["is_month_end"].alias("me")).collect()}
    assert got["2023-01-01"] == (0, 6, 0)
    assert got["2024-02-29"][2] == 1
    assert got["2024-12-30"][0] == 53 and got["2024-12-31"] == (53, 1, 1)


def test_rounding_modes(spark):
    values = ["2.675", "0.125", "1.005", "0.25", "0.35", "84.85", "-2.5", "12.25"]
    df = spark.createDataFrame([(float(v), v) for v in values], "x double, s string")
    out = df.select("s", round_half_up("x", 2).alias("up2"), round_half_even("x", 2).alias("even2"),
                    round_half_up("x", 1).alias("up1"), round_half_even("x", 1).alias("even1")).collect()
    for r in out:
        d = Decimal(r.s)
        # SQL ROUND: half away from zero on the decimal value
        assert r.up2 == float(d.quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert r.up1 == float(d.quantize(Decimal("0.1"), ROUND_HALF_UP))
        # pandas / numpy round: ties to even on the scaled binary value
        assert r.even2 == float(np.round(float(r.s), 2))
        assert r.even1 == float(np.round(float(r.s), 1))
    got = {r.s: (r.up2, r.even2) for r in out}
    assert got["2.675"] == (2.68, 2.68) and got["0.125"] == (0.13, 0.12) and got["1.005"] == (1.01, 1.0)
