"""Stand-in inputs built from the TPC-H-like test tables.

The raw inputs of the reference (suppliers, products, warehouses, orders,
inventory CSVs) are not shipped; these functions give the test tables the
same shape.  They only rename, re-key and derive attributes; none of them
does any of the analytics — every query then runs through the library code.

Mapping (one row per source row, except the brand-grain product table):

* supplier ⋈ nation                        → suppliers
* part                                     → products (category = p_type)
* region                                   → warehouses
* lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part → orders; the
  warehouse is the customer's region, status comes from the return flag
* observed (product, warehouse) pairs ⋈ part → stocked assortment with an
  initial stock and a fortnightly restock quantity (ledger input)
* ``l_orderkey`` repeats on every line of an order, so ``order_id`` is no key here
  (the reference numbers every order row); nothing joins on it
* brand grain for the forecast: at these scales a part sells ~30 times in
  seven years, so the forecast treats each brand as a product
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.operators.joins import broadcast_or_hash, hashed

@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one test table (the DataFrame is reused; plans are immutable)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=None)
def _supplier_count(spark: SparkSession, sf_dir: str) -> int:
    # Parquet row count from file footers: a bounded scalar, not data.
    return table(spark, sf_dir, "supplier").count()


@lru_cache(maxsize=64)
def raw_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .select(s.s_suppkey.alias("supplier_id"),
                     s.s_name.alias("supplier_name"),
                     n.n_name.alias("country"),
                     F.concat(F.lit("sales@"), F.lower(F.regexp_replace(s.s_name, "[^A-Za-z0-9]+", "-")),
                              F.lit(".example.com")).alias("contact_email"),
                     ((F.lit(65) + s.s_suppkey % 35).cast("double") / 100).alias("on_time_rate"),
                     (F.lit(5) + s.s_suppkey % 24).cast("int").alias("avg_lead_time_days")))


@lru_cache(maxsize=64)
def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    n_sup = _supplier_count(spark, sf_dir)
    price = p.p_retailprice.cast("decimal(18,2)")
    return p.select(
        p.p_partkey.alias("product_id"),
        p.p_name.alias("product_name"),
        p.p_type.alias("category"),
        (p.p_partkey % F.lit(n_sup)).alias("supplier_id"),
        (price * (F.lit(40) + p.p_size).cast("decimal(4,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)").alias("unit_cost"),
        price.alias("unit_price"),
        p.p_size.alias("base_demand"),
    )


@lru_cache(maxsize=64)
def raw_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(
        r.r_regionkey.alias("warehouse_id"),
        F.concat(r.r_name, F.lit(" DC")).alias("warehouse_name"),
        r.r_name.alias("city"),
        F.substring(r.r_name, 1, 2).alias("state"),
        (F.lit(50000) + F.lit(5000) * r.r_regionkey).cast("int").alias("capacity"),
    )


@lru_cache(maxsize=64)
def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Doubles become decimals by way of text: a price once for each part, and whole units as numbers.
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(18,2)").alias("price"))
    units = F.col("l_quantity").cast("bigint")
    exact = F.when(units == F.col("l_quantity"), units.cast("decimal(10,0)")).otherwise(F.col("l_quantity").cast("decimal(10,0)"))
    # The orders meet their customers before the lines do, so the lines are dealt by their order only;
    # the orders of a partition, two numbers each, are hashed and its lines not sorted.  Names come last.
    # Customers and parts that are too many for a broadcast are hashed as well.
    placed = o.join(broadcast_or_hash(c, "c_custkey"), o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")
    j = (li.join(hashed(placed, "o_orderkey", rows=o.count()), li.l_orderkey == placed.o_orderkey)
           .join(broadcast_or_hash(p, "p_partkey"), li.l_partkey == p.p_partkey)
           .join(n, placed.c_nationkey == n.n_nationkey)
           .join(r, n.n_regionkey == r.r_regionkey))
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("n_regionkey").alias("warehouse_id"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
        units.alias("quantity"),
        F.col("price").alias("unit_price"),
        (exact * F.col("price").cast("decimal(10,2)")).cast("decimal(18,2)").alias("total_amount"),
        F.when(F.col("l_linenumber") % 3 == 0, "Standard")
         .when(F.col("l_linenumber") % 3 == 1, "Express")
         .otherwise("Overnight").alias("shipping_method"),
        F.when(F.col("l_returnflag") == "N", "Delivered")
         .when(F.col("l_returnflag") == "A", "Delayed")
         .otherwise("Cancelled").alias("status"),
    )


def stocked_assortment(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """(product, warehouse) pairs that appear in the order history, with the
    opening stock (20 + size) and the fortnightly restock (1 + size % 4)."""
    orders = orders if orders is not None else raw_orders(spark, sf_dir)
    pairs = orders.select("product_id", "warehouse_id").distinct()
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), "p_size")
    return (pairs.join(p, "product_id")
                 .select("product_id", "warehouse_id",
                         (F.lit(20) + F.col("p_size")).cast("bigint").alias("initial_stock"),
                         (F.lit(1) + F.col("p_size") % 4).cast("bigint").alias("restock_qty")))


def brand_orders(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Orders re-keyed to the brand grain used by the forecast."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_id"), "p_brand")
    o = orders if orders is not None else raw_orders(spark, sf_dir)
    return (o.join(broadcast_or_hash(p, "part_id"), o.product_id == p.part_id)
             .withColumn("product_id", F.col("p_brand"))
             .drop("part_id", "p_brand"))


@lru_cache(maxsize=64)
def brand_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product row per brand; base demand is the brand's mean part size."""
    p = table(spark, sf_dir, "part")
    return (p.groupBy("p_brand")
             .agg(F.avg("p_size").alias("base_demand"))
             .select(F.col("p_brand").alias("product_id"),
                     F.col("p_brand").alias("product_name"),
                     F.concat(F.lit("Cat"),
                              (F.substring("p_brand", 7, 8).cast("int") % 5).cast("string")).alias("category"),
                     F.col("base_demand").cast("double").alias("base_demand")))


class TestTables:
    """The stand-in inputs as a source of the star schema."""

    __test__ = False   # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.name = spark, sf_dir, sf_dir

    def suppliers(self) -> DataFrame:
        return raw_suppliers(self.spark, self.sf_dir)

    def products(self) -> DataFrame:
        return raw_products(self.spark, self.sf_dir)

    def warehouses(self) -> DataFrame:
        return raw_warehouses(self.spark, self.sf_dir)

    def orders(self) -> DataFrame:
        return raw_orders(self.spark, self.sf_dir)

    def assortment(self, orders: DataFrame) -> DataFrame:
        """What is stocked where; the ledger turns it into daily snapshots."""
        return stocked_assortment(self.spark, self.sf_dir, orders)
