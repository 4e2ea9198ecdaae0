"""Whole-table RANK / dense ordinal without funnelling rows into one task.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row to a single
partition.  For tables that grow with the data (one row per supplier or per
product) we rank in parallel instead:

1. count the rows of every distinct ordering value (partial aggregation, so a
   value shared by a third of the rows collapses map-side into one row);
2. range-partition those distinct values on the ordering (partitions are
   ordered) and take a running sum of the counts inside each partition;
3. add the total count of all earlier partitions, from a table with one row
   per partition (bounded by the partition count, so broadcastable):
   ``rank(value) = rows strictly before it + 1``;
4. join the ranks back on the ordering values (null-safe), whose strategy the
   planner picks by the value table's actual size.

The result equals ``rank() over (order by ...)``.  The staged values are
checkpointed so a recomputation after executor loss sees the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_PID = "__rank_pid"


def _value_ranks(values: DataFrame, order: Sequence[Column], partitions: int) -> DataFrame:
    """``values`` has one row per distinct ordering value and a ``__n`` count."""
    staged = (values.repartitionByRange(partitions, *order)
                    .withColumn(_PID, F.spark_partition_id())
                    .checkpoint(eager=True))
    local = (Window.partitionBy(_PID).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sizes = staged.groupBy(_PID).agg(F.sum("__n").alias("__part_n"))
    # One row per partition: bounded by ``partitions``.
    offsets = sizes.select(
        _PID, F.coalesce(F.sum("__part_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                         F.lit(0)).alias("__offset"))
    return (staged.withColumn("__upto", F.sum("__n").over(local))
                  .join(F.broadcast(offsets), _PID)
                  .withColumn("__rank", (F.col("__offset") + F.col("__upto") - F.col("__n") + 1).cast("int"))
                  .drop(_PID, "__n", "__upto", "__offset"))


def global_rank(df: DataFrame, order: Sequence[tuple[str | Column, bool]], rank_col: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = RANK() OVER (ORDER BY ...) computed in parallel.

    ``order`` lists ``(expression, descending)`` pairs; NULLs sort as in
    Spark's defaults (first ascending, last descending)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"__k{i}" for i in range(len(order))]
    exprs = [F.col(e) if isinstance(e, str) else e for e, _ in order]
    keyed = df.select("*", *[e.alias(k) for e, k in zip(exprs, keys)])
    key_order = [F.col(k).desc() if desc else F.col(k).asc() for k, (_, desc) in zip(keys, order)]
    values = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    ranks = _value_ranks(values, key_order, n)
    cond = reduce(lambda a, b: a & b, [keyed[k].eqNullSafe(ranks[k]) for k in keys])
    out = keyed.join(ranks, cond, "inner")
    return out.select(*[keyed[c] for c in df.columns], F.col("__rank").alias(rank_col))


def ordinal_encode(df: DataFrame, col: str, out_col: str, partitions: int | None = None) -> DataFrame:
    """Label encoding: position (0-based) of each value in the sorted list of
    distinct values — ``sklearn``'s LabelEncoder as an ordinal number.

    Returns a lookup table (value, ordinal); join it back where needed.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = (df.select(col).where(F.col(col).isNotNull())
                .groupBy(col).agg(F.lit(1).alias("__n")))
    return (_value_ranks(values, [F.col(col).asc()], n)
            .select(col, (F.col("__rank") - 1).cast("int").alias(out_col)))
