"""Broadcast, or hash, behind an explicit size check.

Stored dimensions need no hint: the planner knows their size and picks the
strategy.  For a side of which only the caller knows that it may be small:

``bounded_broadcast`` counts the small side (cheap for a parquet dimension:
the count comes from file footers; for a computed side it is checkpointed to
the shared folder first, so the count and the join read the same stored rows)
and wraps it in ``broadcast()`` only when the count is under ``max_rows`` and
the estimated size (count × schema row width) is under ``max_bytes``.
Beyond the bound the plain DataFrame is returned and the planner falls back
to a shuffle join (sort-merge / shuffled hash, AQE skew handling).

``hashed`` is for the smaller side of a join with a fact: both sides are dealt by the
key and the smaller is hashed, so the fact's rows, many times as many, are not sorted
in the tasks' memory.  A hash cannot spill: with more than ``HASHED_ROWS`` rows for
each of the session's shuffle partitions the side asks for more partitions, and the
fact is dealt into as many.  ``broadcast_or_hash`` hashes a dimension that is beyond
the bounds of a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds for a broadcast side: rows, and estimated bytes (rows × row width).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# Rows that a task hashes for a join.
HASHED_ROWS = 500_000

_WIDTH = {"string": 32, "binary": 32, "date": 4, "int": 4, "smallint": 2, "tinyint": 1, "boolean": 1,
          "float": 4}


def row_width(df: DataFrame) -> int:
    """Rough bytes per row from the schema (strings counted at 32 bytes)."""
    return 8 + sum(_WIDTH.get(t, 16 if t.startswith(("decimal", "array", "map", "struct")) else 8)
                   for _, t in df.dtypes)


def _fits(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    n = df.count()
    return n <= max_rows and n * row_width(df) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      materialize: bool = False, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    if materialize:
        df = df.checkpoint(eager=True)
    return F.broadcast(df) if _fits(df, max_rows, max_bytes) else df


def hashed(df: DataFrame, key: str, rows: int | None = None, most: int = HASHED_ROWS) -> DataFrame:
    """``rows``: how many rows ``df`` has, if the caller knows."""
    n = -(-(df.count() if rows is None else rows) // most)
    if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(n, key)
    return df.hint("shuffle_hash")


def broadcast_or_hash(df: DataFrame, key: str, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if _fits(df, max_rows, max_bytes) else hashed(df, key)
