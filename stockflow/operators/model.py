"""Random-forest demand model, evaluation and the frozen-feature forecast.

* ``fit_forest``        — Spark ML ``RandomForestRegressor`` (distributed,
  histogram-based trees).  The reference's library tries every feature at
  each split, so ``featureSubsetStrategy='all'`` (Spark's ``auto`` would use
  one third for regression).
* ``predict``           — batched ``transform`` floored at 0.
* ``error_metrics``     — MAE, RMSE, MAPE (denominator ``max(y, 1)``).
* ``feature_importance``— one row per feature.
* ``forecast_features`` — per product, the last 30 feature rows fix the lag /
  rolling inputs for every future day (no recursion); products with fewer
  than 30 rows, or never sold, fall back to ``base_demand``; unknown labels
  encode to 0.  Future days are generated inside each product row.
* ``forecast_rows``     — rounded prediction and a reorder flag that compares
  the *unrounded* prediction with ``base_demand × reorder_factor``.
* ``monthly_rollup``    — month × product sums of the rounded predictions and
  of the flags.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow.functions.calendar import calendar_attributes, iso_date, month_label
from stockflow.functions.numeric import round_half_even
from stockflow.operators.features import FEATURES, TARGET

PREDICTION = "prediction"

# The reference model's settings (trees, depth, minimum leaf
# size, seed), its forecast horizon in days, the history depth that freezes the
# forecast inputs, and the reorder factor over base demand.
NUM_TREES, MAX_DEPTH, MIN_LEAF, SEED = 100, 12, 5, 42
HORIZON, HISTORY_DEPTH, REORDER_FACTOR = 90, 30, 1.2
# Training rows in a partition: their number follows from the rows, never from the
# cluster's size of the moment.
FIT_ROWS = 16_000


def assemble(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    cast = df.select(*df.columns, *[F.col(c).cast("double").alias(f"__f_{c}") for c in features])
    va = VectorAssembler(inputCols=[f"__f_{c}" for c in features], outputCol="features",
                         handleInvalid="error")
    return va.transform(cast).drop(*[f"__f_{c}" for c in features])


def fit_forest(train: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET,
               num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, min_leaf: int = MIN_LEAF, seed: int = SEED,
               max_bins: int = 64, max_memory_mb: int = 512, partitions: int | None = None,
               keys: Sequence[str] = ("product_id", "full_date"), bootstrap: bool = True) -> RandomForestRegressionModel:
    """Rows are dealt by a hash of ``keys`` into as many partitions as their number
    asks for and sorted there: the sampled trees do not depend on the cluster's size."""
    partitions = partitions or max(1, -(-train.count() // FIT_ROWS))
    dealt = train.repartition(partitions, *keys).sortWithinPartitions(*keys, target)
    data = assemble(dealt, features).select("features", F.col(target).cast("double").alias("label"))
    rf = RandomForestRegressor(numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=min_leaf,
                               seed=seed, featureSubsetStrategy="all", maxBins=max_bins,
                               subsamplingRate=1.0, bootstrap=bootstrap, maxMemoryInMB=max_memory_mb,
                               cacheNodeIds=True, checkpointInterval=10,
                               labelCol="label", featuresCol="features", predictionCol=PREDICTION)
    return rf.fit(data)


def predict(model: RandomForestRegressionModel, df: DataFrame,
            features: Sequence[str] = FEATURES) -> DataFrame:
    out = model.transform(assemble(df, features))
    return out.drop("features").withColumn(PREDICTION, F.greatest(F.col(PREDICTION), F.lit(0.0)))


def error_metrics(scored: DataFrame, target: str = TARGET, prediction: str = PREDICTION) -> DataFrame:
    """One row: mae, rmse (2 dp), mape (1 dp), test_rows."""
    y = F.col(target).cast("double")
    e = y - F.col(prediction).cast("double")
    return scored.agg(
        round_half_even(F.avg(F.abs(e)), 2).alias("mae"),
        round_half_even(F.sqrt(F.avg(e * e)), 2).alias("rmse"),
        round_half_even(F.avg(F.abs(e) / F.greatest(y, F.lit(1.0))) * 100, 1).alias("mape"),
        F.count(F.lit(1)).alias("test_rows"),
    )


def feature_importance(spark: SparkSession, model: RandomForestRegressionModel,
                       features: Sequence[str] = FEATURES) -> DataFrame:
    """The model's 13 importances (a fixed-size vector) as a table."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.col("importance").desc()))


def recent_history(features_df: DataFrame, depth: int = HISTORY_DEPTH) -> DataFrame:
    """Per product: how many of the last ``depth`` rows exist, and the values
    at positions 7 / 14 / 30 from the end and the means of the last 7 / 30."""
    w = Window.partitionBy("product_id").orderBy(F.col("full_date").desc())
    last = (features_df.select("product_id", "full_date", "units_sold")
            .withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") <= depth))
    at = lambda k: F.max(F.when(F.col("__rn") == k, F.col("units_sold"))).cast("double")
    return (last.groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("__n"),
                 at(7).alias("__l7"), at(14).alias("__l14"), at(30).alias("__l30"),
                 F.avg(F.when(F.col("__rn") <= 7, F.col("units_sold"))).alias("__r7"),
                 F.avg(F.col("units_sold")).alias("__r30")))


def forecast_features(features_df: DataFrame, products: DataFrame, product_enc: DataFrame,
                      category_enc: DataFrame, start: str, horizon: int = HORIZON,
                      depth: int = HISTORY_DEPTH) -> DataFrame:
    """Feature rows for ``horizon`` future days of every product."""
    hist = recent_history(features_df, depth)
    base = F.col("base_demand").cast("double")
    full = F.coalesce(F.col("__n"), F.lit(0)) >= depth
    pick = lambda c: F.when(full, F.col(c)).otherwise(base)
    end = (date.fromisoformat(start).toordinal() + horizon - 1)
    end_iso = date.fromordinal(end).isoformat()
    prod = (products.select("product_id", "product_name", "category", "base_demand")
            .join(hist, "product_id", "left")
            .join(product_enc, "product_id", "left")
            .join(category_enc, "category", "left")
            .select("product_id", "product_name", "category",
                    F.coalesce("product_enc", F.lit(0)).cast("int").alias("product_enc"),
                    F.coalesce("category_enc", F.lit(0)).cast("int").alias("category_enc"),
                    base.alias("base_demand"),
                    pick("__l7").alias("lag_7"), pick("__l14").alias("lag_14"), pick("__l30").alias("lag_30"),
                    pick("__r7").alias("rolling_7"), pick("__r30").alias("rolling_30"),
                    F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end_iso)),
                                         F.expr("interval 1 day"))).alias("__d")))
    cal = calendar_attributes("__d")
    return prod.select(iso_date("__d").alias("forecast_date"), "product_id", "product_name", "category",
                       cal["month"].alias("month"), cal["quarter"].alias("quarter"),
                       cal["week_number"].alias("week_number"), cal["day_of_week"].alias("day_of_week"),
                       cal["is_weekend"].alias("is_weekend"),
                       "product_enc", "category_enc", "base_demand",
                       "lag_7", "lag_14", "lag_30", "rolling_7", "rolling_30")


def forecast_rows(scored: DataFrame, prediction: str = PREDICTION,
                  reorder_factor: float = REORDER_FACTOR) -> DataFrame:
    p = F.greatest(F.col(prediction).cast("double"), F.lit(0.0))
    return scored.select(
        "forecast_date", "product_id", "product_name", "category",
        round_half_even(p, 1).alias("predicted_units"),
        (p > F.col("base_demand").cast("double") * reorder_factor).cast("int").alias("reorder_flag"),
    )


def monthly_rollup(rows: DataFrame, date_col: str, value: str, flag: str,
                   value_out: str, flag_out: str, scale: int = 1) -> DataFrame:
    """month × product sums of a (rounded) value and of a 0/1 flag.  The value
    is summed as an exact decimal so the total does not depend on order."""
    return (rows.withColumn("month", month_label(F.to_date(date_col)))
            .groupBy("month", "product_id", "product_name", "category")
            .agg(F.sum(F.col(value).cast(f"decimal(28,{scale})")).cast("double").alias(value_out),
                 F.sum(F.col(flag)).cast("bigint").alias(flag_out)))
