"""From raw documents to packed training sequences.

Five stages, each over all that its predecessor kept: toxic documents go, one
document of each near-duplicate group stays, documents with benchmark passages
go, personal data is masked, the rest is packed.  Each stage's result is
written to the shared folder and read again, so a stage never recomputes an
earlier one.  All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockflow.llm import catalog, decontam, neardup, packing, pii, toxicity
from stockflow.llm.common import ready, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, catalog.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, catalog.table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near-duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("personal data", mask_personal_data), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the pieces of the packed sequences."""
    ready(spark)
    docs = catalog.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# SQL can express neither a fitted model, a tokenizer nor edit distance; tests hold the stages against brute force.
ORACLE_SQL = None

QUERIES = dict(catalog.QUERIES) | {"pipeline": run}
ORACLES = dict(catalog.ORACLE_SQL) | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
