"""Demand forecast over the star schema.

``DemandForecast`` wires the operators: daily demand → features → time
split → forest → evaluation, importances, 90-day forecast and its monthly
rollup.  The feature table and the label encoders are materialised once per
application in the shared checkpoint folder, and the fitted model is kept
for the session, so every report re-uses one fit.  What is stored or kept is not
built anew if the input changes under the same path.

Beside the forest stands one deterministic tree (``tree_*``), and both exist as
node tables: ``save_forest`` stores the forest, and a forecast given its folder
as ``forest_path`` scores from the nodes without a fit.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.operators import facts
from stockflow.operators import features as feat
from stockflow.operators import model as mdl
from stockflow.operators import tree
from stockflow.plans.warehouse import StarSchema, star_schema
from stockflow.session import shared_dir
from stockflow.sources import testdata

ROW = ["product_id", "full_date"]
FUTURE = ["forecast_date", "product_id", "product_name", "category", "base_demand"]

_lock = threading.Lock()
_registry: dict[tuple, DemandForecast] = {}


class DemandForecast:
    """Forecast over fact_orders, dim_date and dim_products frames; ``start`` is
    the first day to forecast.  ``key`` names the inputs (stored tables go under it).
    Without a ``cutoff`` the test rows begin where ``train_percent`` of them lie before."""

    def __init__(self, fact_orders: DataFrame, dim_date: DataFrame, dim_products: DataFrame, start: str, key: str,
                 cutoff: str | None = None, train_percent: int = feat.TRAIN_PERCENT, horizon: int = mdl.HORIZON, num_trees: int = mdl.NUM_TREES,
                 max_depth: int = mdl.MAX_DEPTH, min_leaf: int = mdl.MIN_LEAF, seed: int = mdl.SEED,
                 reorder_factor: float = mdl.REORDER_FACTOR, forest_path: str | None = None):
        self.spark = fact_orders.sparkSession
        self._fact_orders, self._dim_date, self._dim_products = fact_orders, dim_date, dim_products
        self._cutoff, self.train_percent, self.start, self.horizon = cutoff, train_percent, start, horizon
        self.forest_path = forest_path
        self.forest_params = dict(num_trees=num_trees, max_depth=max_depth, min_leaf=min_leaf, seed=seed)
        self.reorder_factor = reorder_factor
        self._cache: dict[str, object] = {}
        self._locks: dict[str, threading.RLock] = {}
        digest = hashlib.sha1(f"{key}|{cutoff}|{train_percent}|{start}|{horizon}".encode()).hexdigest()[:12]
        self.root = shared_dir(self.spark, "forecast", digest, uuid.uuid4().hex[:8])

    @classmethod
    def from_schema(cls, ws: StarSchema, **kw) -> DemandForecast:
        """The forecast of a warehouse's own products."""
        return cls(ws.table("fact_orders"), ws.table("dim_date"), ws.table("dim_products"),
                   kw.pop("start", ws.day_after()), f"products of {ws.source.name}", **kw)

    @classmethod
    def of_brands(cls, ws: StarSchema, **kw) -> DemandForecast:
        """The stand-in tables with each brand as a product: a part sells too rarely."""
        spark, sf_dir = ws.spark, ws.source.sf_dir
        orders = facts.fact_orders(testdata.brand_orders(spark, sf_dir, ws.raw("orders")))
        return cls(orders, ws.table("dim_date"), testdata.brand_products(spark, sf_dir),
                   kw.pop("start", ws.day_after()), f"brands of {ws.source.name}", **kw)

    # -- inputs ------------------------------------------------------------------
    def fact_orders(self) -> DataFrame:
        return self._fact_orders

    def dim_date(self) -> DataFrame:
        return self._dim_date

    def dim_products(self) -> DataFrame:
        return self._dim_products

    # -- history and features --------------------------------------------------
    def daily(self) -> DataFrame:
        """One row per product and selling day, stored once: the orders are read
        for it and never again by the encoders or the features."""
        def build():
            path = f"{self.root}/daily"
            feat.daily_demand(self.fact_orders(), self.dim_date(), self.dim_products()).write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path)
        return self._memo("daily", build)

    def encoders(self) -> tuple[DataFrame, DataFrame]:
        def build():
            p, c = feat.label_encoders(self.daily())
            return p.checkpoint(eager=True), c.checkpoint(eager=True)
        return self._memo("encoders", build)

    def features_plan(self) -> DataFrame:
        return self._memo("features_plan", lambda: feat.demand_features(self.daily(), encoders=self.encoders()))

    def features(self) -> DataFrame:
        def build():
            path = f"{self.root}/features"
            self.features_plan().write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path)
        return self._memo("features", build)

    @property
    def cutoff(self) -> str:
        return self._memo("cutoff", lambda: self._cutoff or feat.share_cutoff(self.features(), "full_date", self.train_percent))

    def split(self) -> tuple[DataFrame, DataFrame]:
        return feat.time_split(self.features(), "full_date", self.cutoff)

    # -- model -----------------------------------------------------------------
    def model(self):
        def build():
            train, _ = self.split()
            return mdl.fit_forest(train, **self.forest_params)
        return self._memo("model", build)

    def test_predictions(self) -> DataFrame:
        """Held-out rows scored once (the transform ships the whole forest to
        the executors, so the scored frame is shared by every report)."""
        def build():
            _, test = self.split()
            return mdl.predict(self.model(), test).select("full_date", "product_id", "units_sold", "prediction")
        return self._memo("test_predictions", build)

    def model_metrics(self) -> DataFrame:
        train, _ = self.split()
        n_train = self._memo("train_rows", train.count)
        m = self._memo("error_metrics", lambda: mdl.error_metrics(self.test_predictions()))
        return m.select(F.lit("RandomForestRegressor").alias("model"), "mae", "rmse", "mape",
                        F.lit(n_train).cast("bigint").alias("train_rows"), "test_rows",
                        F.lit(len(feat.FEATURES)).cast("int").alias("n_features"),
                        F.lit(self.cutoff).alias("cutoff_date"))

    def feature_importance(self) -> DataFrame:
        return mdl.feature_importance(self.spark, self.model())

    # -- node tables -----------------------------------------------------------
    def save_forest(self, path: str) -> str:
        """Store the fitted forest (a folder that a later application can score from)."""
        self.model().write().overwrite().save(path)
        return path

    def forest_nodes(self) -> DataFrame:
        """The forest as rows: from ``forest_path`` if given, else from this fit, stored once."""
        def build():
            return tree.forest_nodes(self.spark, self.forest_path or self.save_forest(f"{self.root}/forest"))
        return self._memo("forest_nodes", build)

    def tree_nodes(self) -> DataFrame:
        """One deterministic tree over the training rows."""
        def build():
            path = f"{self.root}/tree"
            tree.grow_tree(self.split()[0]).coalesce(1).write.mode("overwrite").parquet(path)   # at most 2^(depth + 1) rows
            return self.spark.read.parquet(path)
        return self._memo("tree_nodes", build)

    def node_predictions(self, nodes: DataFrame, depth: int) -> DataFrame:
        """Held-out rows scored from a node table."""
        _, test = self.split()
        scored = tree.score(test, nodes, [*ROW, "units_sold"], depth)
        return scored.select("full_date", "product_id", "units_sold", "prediction")

    def node_forecast(self, nodes: DataFrame, depth: int) -> DataFrame:
        """The forecast from a node table."""
        return mdl.forecast_rows(tree.score(self.future_features(), nodes, FUTURE, depth), reorder_factor=self.reorder_factor)

    def forest_depth(self) -> int:
        return self.forest_params["max_depth"]

    # -- forecast --------------------------------------------------------------
    def future_features(self) -> DataFrame:
        def build():
            p, c = self.encoders()
            return mdl.forecast_features(self.features(), self.dim_products(), p, c, self.start, self.horizon)
        return self._memo("future_features", build)

    def forecast(self) -> DataFrame:
        def build():
            scored = mdl.predict(self.model(), self.future_features())
            return mdl.forecast_rows(scored, reorder_factor=self.reorder_factor)
        return self._memo("forecast", build)

    def monthly(self, rows: DataFrame | None = None) -> DataFrame:
        rows = rows if rows is not None else self.forecast()
        return mdl.monthly_rollup(rows, "forecast_date", "predicted_units", "reorder_flag",
                                  "predicted_units", "reorder_days")

    # -- naive predictor (prediction := rolling_7), oracle-checkable ------------
    def naive_forecast(self) -> DataFrame:
        rows = self.future_features().withColumn(mdl.PREDICTION, F.col("rolling_7"))
        return mdl.forecast_rows(rows, reorder_factor=self.reorder_factor)

    def naive_error(self) -> DataFrame:
        _, test = self.split()
        scored = test.withColumn(mdl.PREDICTION, F.greatest(F.col("rolling_7"), F.lit(0.0)))
        return mdl.error_metrics(scored)

    def _memo(self, key, build):
        with _lock:
            if key in self._cache:
                return self._cache[key]
            key_lock = self._locks.setdefault(key, threading.RLock())
        with key_lock:   # one build per key, even with concurrent callers
            with _lock:
                if key in self._cache:
                    return self._cache[key]
            value = build()
            with _lock:
                return self._cache.setdefault(key, value)


def top_by(monthly: DataFrame, month: str, value: str, k: int = 5) -> DataFrame:
    """Top ``k`` products of one month (ties broken by product id)."""
    return (monthly.where(F.col("month") == month)
            .orderBy(F.col(value).desc(), "product_id").limit(k))


def demand_forecast(spark: SparkSession, sf_dir: str, **kw) -> DemandForecast:
    key = (spark.sparkContext.applicationId, sf_dir, tuple(sorted(kw.items())))
    with _lock:
        if key not in _registry:
            _registry[key] = DemandForecast.of_brands(star_schema(spark, sf_dir), **kw)
        return _registry[key]
