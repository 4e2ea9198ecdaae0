"""Rounding, ratio and conditional-aggregate helpers.

Three rounding modes appear in the reference and are kept apart:

* SQL ``ROUND`` — half away from zero          → :func:`round_half_up`
* pandas ``Series.round`` — half to even        → :func:`round_half_even`
* Python scalar ``round`` — half to even        → :func:`round_half_even`

SQL rounding fixes doubles to ten decimals (``DECIMAL(38,10)``) and rounds
the decimal, as SQL engines round the decimal text of a value.  numpy rounds
the scaled binary value with ``rint``; :func:`round_half_even` does the same,
so it needs no decimal arithmetic per row.  Money stays ``DECIMAL`` until display, where it is
turned into ``DOUBLE``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
WIDE_MONEY = "decimal(38,2)"
_FIXED = "decimal(38,10)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(x: Column | str, scale: int) -> Column:
    """SQL ``ROUND(x, scale)`` on a double or decimal, returned as double."""
    return F.round(_c(x).cast(_FIXED), scale).cast("double")


def round_half_even(x: Column | str, scale: int) -> Column:
    """pandas / numpy ``round(x, scale)``: ``rint(x * 10**scale) / 10**scale``
    on doubles (ties to even on the scaled binary value), exactly as numpy
    computes it; no per-row decimal arithmetic."""
    f = float(10 ** scale)
    return F.rint(_c(x).cast("double") * f) / f


def money_out(x: Column | str) -> Column:
    """Display form of an exact money aggregate: 2 dp as double."""
    return F.round(_c(x).cast(WIDE_MONEY), 2).cast("double")


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / NULLIF(den, 0)`` in double: NULL when the divisor is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))


def count_where(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` — NULL conditions count 0."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
