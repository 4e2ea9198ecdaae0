"""Star-schema build: a source of raw tables → four dimensions and two facts.

A source has ``suppliers``, ``products``, ``warehouses`` and ``orders``, and
either ``inventory`` (daily snapshots, as in a folder of CSV files) or
``assortment`` (what is stocked where; the stock ledger derives the snapshots).
Every date range follows from the orders: the calendar and the snapshots run
from the first order day to the last, the horizon is their number of days.

``StarSchema.plan(name)`` returns the lazily-defined build of one table (what
the correctness queries compare); ``StarSchema.table(name)`` materialises it
once per application as parquet in the shared checkpoint folder and reads it
back, so downstream queries start from stored rows instead of re-running the
lineage (and survive executor loss).  A table is not built anew if the source
changes under the same name.  Landed orders and both facts are partitioned by
year: ``by_year(name)`` shows that column, so a filter on it prunes folders, and a
join with filtered calendar days on (year, day) prunes them at run time.  The
snapshots of a derived ledger are stored once, as its stretches with each product's
demand (a row for each day with sales, not for each day); the daily rows of the
fact and of the raw snapshots are expanded from them as they are read.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.calendar import date_key
from stockflow.operators import days, dims, facts, ledger
from stockflow.session import shared_dir
from stockflow.sources import files, testdata

TABLES = ["raw_orders", "dim_date", "dim_suppliers", "dim_products", "dim_warehouses", "fact_orders",
          "raw_inventory", "fact_inventory"]

# The year of a row, by which these tables are stored.
YEAR = "__year"
# Tasks of daily rows whose stretches are written by one task.
STRETCHED = 4
BY_YEAR = {"raw_orders", "raw_inventory", "fact_orders", "fact_inventory"}

_lock = threading.Lock()
_registry: dict[tuple, StarSchema] = {}


class StarSchema:
    def __init__(self, spark: SparkSession, source):
        self.spark, self.source = spark, source
        self._values: dict[str, object] = {}
        self._locks: dict[str, threading.RLock] = {}
        key = hashlib.sha1(str(source.name).encode()).hexdigest()[:12]
        self.root = shared_dir(spark, "warehouse", key)

    # -- date ranges -------------------------------------------------------------
    def order_days(self) -> tuple[date, date]:
        """First and last order day: one aggregate over the landed orders."""
        def build():
            first, last = self.raw("orders").agg(F.min(F.to_date("order_date")), F.max(F.to_date("order_date"))).first()
            if first is None:
                raise ValueError(f"{self.source.name}: no dated order, so the calendar has no range")
            return first, last
        return self._memo("days", build)

    @property
    def horizon_days(self) -> int:
        first, last = self.order_days()
        return (last - first).days + 1

    def day_after(self) -> str:
        return (self.order_days()[1] + timedelta(days=1)).isoformat()

    # -- raw inputs ----------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        """Raw inputs.  Orders are landed once as parquet, so every consumer reads
        stored rows."""
        if name == "orders":
            return self.table("raw_orders")
        if name == "inventory":
            return self.table("raw_inventory")
        return self._memo(f"raw {name}", getattr(self.source, name))

    def assortment(self) -> DataFrame:
        """What is stocked where, of a source that derives its snapshots; stored once."""
        def build():
            path = f"{self.root}/assortment"
            files.write_table(self.source.assortment(self.raw("orders")), path)
            return files.read_table(self.spark, path)
        return self._memo("assortment", build)

    # -- build plans -----------------------------------------------------------------
    def plan(self, name: str) -> DataFrame:
        return self._memo(f"plan {name}", lambda: self._build_plan(name))

    def _build_plan(self, name: str) -> DataFrame:
        if name == "raw_orders":
            return self.source.orders()
        if name == "dim_date":
            return dims.date_dimension(self.spark, *[d.isoformat() for d in self.order_days()])
        if name == "dim_suppliers":
            return dims.supplier_dimension(self.raw("suppliers"))
        if name == "dim_products":
            return dims.product_dimension(self.raw("products"))
        if name == "dim_warehouses":
            return dims.warehouse_dimension(self.raw("warehouses"))
        if name == "fact_orders":
            return facts.fact_orders(self.raw("orders"))
        if name == "raw_inventory":
            if hasattr(self.source, "inventory"):
                return self.source.inventory()
            return self.days(self.plan("stretches"))
        if name == "fact_inventory":
            if hasattr(self.source, "inventory"):
                return facts.fact_inventory(self.raw("inventory"), self._demand())
            return facts.supply_columns(self._days(self.plan("supplied_stretches")))
        if name == "stretches":
            return self.ledger_stretches(self.assortment())
        if name == "supplied_stretches":   # a pair meets its product's demand before the ledger, not each stretch after it
            return self.ledger_stretches(facts.with_demand(self.assortment(), self._demand()), "avg_daily_demand")
        raise KeyError(name)

    def ledger_stretches(self, assortment: DataFrame, *keep: str) -> DataFrame:
        """The ledger's stretches, with the columns ``keep`` of the assortment."""
        first, last = (d.isoformat() for d in self.order_days())
        return ledger.stock_stretches(assortment, self.raw("orders"), first, last, partitions=self.pair_partitions(), keep=keep)

    def _demand(self) -> DataFrame:
        return facts.avg_daily_demand(self.raw("orders"), self.horizon_days)

    def _days(self, stretches: DataFrame) -> DataFrame:
        return ledger.daily(stretches, self.order_days()[0].isoformat())

    def days(self, stretches: DataFrame, *more: str) -> DataFrame:
        """Raw daily snapshots of stretches of this ledger, with the columns ``more``."""
        return self._days(stretches).select(*ledger.LEDGER_COLUMNS, *more)

    def by_month(self, stretches: DataFrame, sums: Callable[[days.Days], dict], schema: str) -> DataFrame:
        """All daily snapshots of stretches of this ledger, summed up by pair and month."""
        return days.by_month(stretches, self.order_days()[0].isoformat(), sums, schema)

    def pair_partitions(self) -> int:
        """Tasks that the daily snapshots of all stocked pairs ask for."""
        return self._memo("pair partitions", lambda: ledger.pair_partitions(self.assortment(), self.horizon_days, self.raw("orders").count()))

    # -- materialised tables -----------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        return self._memo(f"table {name}", lambda: self._materialize(name))

    def by_year(self, name: str) -> DataFrame:
        """A table stored by year, with its folder column :data:`YEAR`."""
        if name not in BY_YEAR:
            raise KeyError(f"{name} is not stored by year")
        columns = self.table(name).columns
        return self._memo(f"stored {name}", lambda: None).select(*columns, YEAR)

    def stretches(self) -> DataFrame:
        """The stored stretches of a derived ledger, with ``avg_daily_demand`` and the folder column :data:`YEAR`."""
        def build():
            path = f"{self.root}/stretches"
            rows = self.plan("supplied_stretches").withColumnRenamed("year", YEAR)
            floor = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            rows = rows.coalesce(max(floor, self.pair_partitions() // STRETCHED))   # a file a task and year
            files.write_table(rows, path, [YEAR])
            return files.read_table(self.spark, path)
        return self._memo("stretches", build)

    def rejects(self) -> DataFrame:
        """(table, file, line, reason) of the source's lines that were left out."""
        if getattr(self.source, "checked", False):
            return self.source.rejects()
        return self.spark.createDataFrame([], "table string, file string, line string, reason string")

    def _materialize(self, name: str) -> DataFrame:
        if name in ("raw_inventory", "fact_inventory") and not hasattr(self.source, "inventory"):
            return self._expanded(name)
        df = self.plan(name)
        columns, schema = df.columns, df.schema
        path = f"{self.root}/{name}"
        if name in BY_YEAR:
            day = "order_date" if name == "raw_orders" else "date"
            year = F.year(F.to_date(F.col(day))) if name.startswith("raw") else F.floor(F.col("date_id") / 10000).cast("int")
            files.write_table(df.withColumn(YEAR, year), path, [YEAR])
        else:
            files.write_table(df, path)
        stored = files.read_table(self.spark, path)
        typed = [F.col(c).cast(schema[c].dataType).alias(c) for c in columns]
        if name in BY_YEAR:
            self._memo(f"stored {name}", lambda: stored.select(*typed, YEAR))
        return stored.select(*typed)

    def _expanded(self, name: str) -> DataFrame:
        """Daily rows of a derived ledger from its stored stretches."""
        schema, rows = self.plan(name).schema, self._days(self.stretches())
        rows = facts.supply_columns(rows, YEAR) if name == "fact_inventory" else rows
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        self._memo(f"stored {name}", lambda: rows.select(*typed, YEAR))
        return rows.select(*typed)

    def _memo(self, key: str, build):
        with _lock:
            if key in self._values:
                return self._values[key]
            key_lock = self._locks.setdefault(key, threading.RLock())
        with key_lock:   # one build per key, even with concurrent callers
            with _lock:
                if key in self._values:
                    return self._values[key]
            value = build()
            with _lock:
                return self._values.setdefault(key, value)


def star_schema(spark: SparkSession, sf_dir: str) -> StarSchema:
    """The star schema over the test tables of ``sf_dir``, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _registry:
            _registry[key] = StarSchema(spark, testdata.TestTables(spark, sf_dir))
        return _registry[key]
