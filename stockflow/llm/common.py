"""Helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.session import ensure_checkpoint_dir, shared_dir, ship_package

# Rows and bytes per Arrow batch: a batch of whole texts must fit a Python worker.
ARROW_ROWS = 1000
ARROW_BYTES = 4 << 20


def ready(spark: SparkSession) -> None:
    """Session settings that every operator needs before it plans a job."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never used twice."""
    return shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage
    ends there, and a lost executor costs no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables that :func:`stored` made and nobody reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = ensure_checkpoint_dir(spark).split(":", 1)[-1].lstrip("/")
    for df in frames:
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            if root in folder and "/llm/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def id_bucket(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids count as empty text."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string): the only columns most operators look at."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def slabs(texts: list[str | None], limit: int) -> Iterator[list[str | None]]:
    """The texts in order in parts of at most ``limit`` characters, or one text."""
    part, held = [], 0
    for t in texts:
        n = len(t or "")
        if part and held + n > limit:
            yield part
            part, held = [], 0
        part.append(t)
        held += n
    if part:
        yield part


def column_values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
