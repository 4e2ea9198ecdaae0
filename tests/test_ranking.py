"""Parallel RANK equals a single-partition window RANK, ties included."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockflow.operators.ranking import global_rank, ordinal_encode


def test_global_rank_matches_window(spark):
    rng = random.Random(3)
    rows = [(i, float(rng.randint(0, 40)) / 7) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, v double")
    ours = {r.id: r.rk for r in global_rank(df, [("v", True)], "rk", partitions=6).collect()}
    ref = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").desc()))).collect()}
    assert ours == ref


def test_ordinal_encode_sorted_labels(spark):
    df = spark.createDataFrame([("Brand#2",), ("Brand#10",), ("Brand#1",), ("Brand#2",), (None,)], "b string")
    got = {r.b: r.enc for r in ordinal_encode(df, "b", "enc", partitions=3).collect()}
    # code-point order, 0-based: Brand#1 < Brand#10 < Brand#2
    assert got == {"Brand#1": 0, "Brand#10": 1, "Brand#2": 2}
