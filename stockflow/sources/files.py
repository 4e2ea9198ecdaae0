"""Readers and writers: CSV in/out with headers, parquet warehouse tables.

* ``read_raw``      — CSV with header and an explicit schema (no inference);
  columns are bound by the names in the header, in any order, extra columns are
  ignored and missing ones are an error.
* ``read_checked``  — the same for imperfect files: (rows, rejects), where a row
  with a cell of another type or too few or many fields is a reject.
* ``CsvFolder``     — the five raw CSV files of a warehouse as a source.
* ``write_csv``     — CSV with header, no index column, overwrite.
* ``write_table``   — replace-if-exists table write (parquet), optional
  ``partitionBy``; the replacement of the reference's ``to_sql(replace)``.  Each
  write is a new version beside the old one; a small file that names the current
  version is replaced in one step at the end, so a job that dies leaves the old
  table.  The version before the current one stays for readers still at it.  With
  ``partitionBy`` a task keeps a file open for each folder instead of sorting its
  rows by folder, so it holds encoded columns and no rows.
* ``read_table``    — full table scan of the current version; column pruning and
  filter pushdown are left to Catalyst.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.sources.schemas import RAW_SCHEMAS


REJECT_COLUMNS = ["file", "line", "reason"]
# Folders that a task writes at a time; Spark sorts a task's rows of further folders, spilling to disk.
OPEN_FOLDERS = 24
_BROKEN = "__broken_line"


def _filed(spark: SparkSession, path: str, table: str | None, schema: T.StructType | None) -> tuple[T.StructType, list[str]]:
    """The wanted schema and the columns of the header."""
    if schema is None:
        if table not in RAW_SCHEMAS:
            raise KeyError(f"no schema for raw table {table!r}; pass schema=")
        schema = RAW_SCHEMAS[table]
    header = spark.read.option("header", True).csv(path).columns   # reads one line
    if missing := [f.name for f in schema.fields if f.name not in header]:
        raise ValueError(f"{path} lacks the columns {missing}")
    if len(set(header)) != len(header):
        raise ValueError(f"{path} repeats a column name: {header}")
    return schema, header


def read_raw(spark: SparkSession, path: str, table: str | None = None,
             schema: T.StructType | None = None) -> DataFrame:
    schema, header = _filed(spark, path, table, schema)
    types = {f.name: f.dataType for f in schema.fields}
    as_filed = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    return (spark.read.schema(as_filed)
            .option("header", True)
            .option("enforceSchema", False)   # every file's header must agree
            .option("mode", "FAILFAST")
            .csv(path)
            .select(*types))


def read_checked(spark: SparkSession, path: str, table: str | None = None,
                 schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): rows whose every cell has its type, and (file, line, reason) of
    the others.  The cells are read as text and cast one by one, so a reject names
    its first bad column.  Rows and rejects together are all lines but headers."""
    schema, header = _filed(spark, path, table, schema)
    text = T.StructType([*[T.StructField(c, T.StringType()) for c in header], T.StructField(_BROKEN, T.StringType())])
    lines = (spark.read.schema(text).option("header", True).option("enforceSchema", False)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)
             .option("columnPruning", False)   # a line's fields are counted whatever is selected
             .csv(path).withColumn("__file", F.col("_metadata.file_path")))
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    bad = [F.when(F.col(f.name).isNotNull() & cast[f.name].isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
           for f in schema.fields if f.dataType != T.StringType()]
    reason = F.coalesce(F.when(F.col(_BROKEN).isNotNull(), F.lit("number of fields")), *bad)
    judged = lines.withColumn("__reason", reason)
    rows = judged.where("__reason is null").select(*[c.alias(n) for n, c in cast.items()])
    line = F.coalesce(F.col(_BROKEN), F.to_csv(F.struct(*header)))
    return rows, judged.where("__reason is not null").select(F.col("__file").alias("file"), line.alias("line"), F.col("__reason").alias("reason"))


class CsvFolder:
    """suppliers.csv, products.csv, warehouses.csv, orders.csv, inventory.csv
    (files or folders of files) as a source of the star schema.  A bad line ends the
    load, or with ``checked`` goes to :meth:`rejects`."""

    TABLES = ("suppliers", "products", "warehouses", "orders", "inventory")

    def __init__(self, spark: SparkSession, folder: str, checked: bool = False):
        self.spark, self.folder, self.name, self.checked = spark, folder.rstrip("/"), folder, checked

    def _read(self, table: str) -> DataFrame:
        path = f"{self.folder}/{table}.csv"
        return read_checked(self.spark, path, table)[0] if self.checked else read_raw(self.spark, path, table)

    def rejects(self) -> DataFrame:
        """(table, file, line, reason) of all five files."""
        parts = [read_checked(self.spark, f"{self.folder}/{t}.csv", t)[1].select(F.lit(t).alias("table"), *REJECT_COLUMNS) for t in self.TABLES]
        return reduce(DataFrame.unionByName, parts)

    def suppliers(self) -> DataFrame:
        return self._read("suppliers")

    def products(self) -> DataFrame:
        return self._read("products")

    def warehouses(self) -> DataFrame:
        return self._read("warehouses")

    def orders(self) -> DataFrame:
        return self._read("orders")

    def inventory(self) -> DataFrame:
        return self._read("inventory").withColumn("date", F.to_date("date"))


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """``single`` puts a small report into one file of the folder."""
    ((df.coalesce(1) if single else df).write.mode("overwrite")
       .option("header", True)
       .csv(path))


def delete(spark: SparkSession, path: str) -> None:
    _, where, files, _ = _file_system(spark, path)
    files.delete(where, True)


_CURRENT = "_current"


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs, where, where.getFileSystem(conf), conf


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder name of the table's current version; null if there is none."""
    hadoop, where, files, _ = _file_system(spark, path)
    pointer = hadoop.Path(where, _CURRENT)
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _point_at(spark: SparkSession, path: str, version: str) -> None:
    """Replace the pointer file in one step."""
    hadoop, where, files, conf = _file_system(spark, path)
    fresh = hadoop.Path(where, f"{_CURRENT}-{uuid.uuid4().hex}")
    out = files.create(fresh, True)
    out.write(version.encode())
    out.close()
    overwrite = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(files.getUri(), conf).rename(files.makeQualified(fresh), files.makeQualified(hadoop.Path(where, _CURRENT)), overwrite)


_open_lock = threading.Lock()


@contextmanager
def _open_folders(spark: SparkSession) -> Iterator[None]:
    """Writes in here keep up to :data:`OPEN_FOLDERS` files open in a task, or more if the session says so."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    with _open_lock:   # the setting is the session's: one such write at a time
        before = spark.conf.get(name)
        spark.conf.set(name, str(max(int(before), OPEN_FOLDERS)))
        try:
            yield
        finally:
            spark.conf.set(name, before)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    spark, version = df.sparkSession, f"version-{uuid.uuid4().hex}"
    before = current_version(spark, path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        with _open_folders(spark):
            writer.partitionBy(*partition_by).parquet(f"{path}/{version}")
    else:
        writer.parquet(f"{path}/{version}")
    _point_at(spark, path, version)
    _, where, files, _ = _file_system(spark, path)
    for entry in files.listStatus(where):   # versions older than the last, and what failed writes left
        name = entry.getPath().getName()
        if name.startswith("version-") and name not in (version, before):
            files.delete(entry.getPath(), True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    return spark.read.parquet(f"{path}/{version}" if version else path)
