"""Queries over the test tables, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm import (ann, arrow_store, chat, conversation_repair, decontam, langid, lm, neardup, ngram_join, oracles, packing, pii, toxicity,
                           whitening)
from stockflow.llm.common import id_bucket

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# How speakers are marked in the stand-in transcripts; the last style names nobody but in the first turn.
_STYLES = [("System: ", "User: ", "Assistant: "), ("Instructions: ", "Human: ", "AI: "), ("### System", "### User", "### Assistant"),
           ("[system] ", "[user] ", "[assistant] "), ("Context: ", "Q: ", "A: "), ("", "", "")]


def transcripts(conversations: DataFrame) -> DataFrame:
    """Stand-in input: each turn's lines, the first with a speaker marker in its
    conversation's style (a marker alone is a line of its own), a blank line
    after the turn where no markers are used."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(_STYLES)))

    def mark(k: int) -> Column:
        out = F.lit("")
        for n, names in enumerate(_STYLES):
            out = F.when(style == n, F.lit(names[k])).otherwise(out)
        return out

    found = F.when(F.col("role") == "system", mark(0)).when(F.col("role") == "user", mark(1)).when(F.col("role") == "assistant", mark(2)).otherwise("")
    alone, bare = style == 2, style == len(_STYLES) - 1
    found = F.when(bare & (F.col("turn") == 0), F.concat(F.initcap("role"), F.lit(": "))).otherwise(found)
    body = F.split(F.coalesce("text", F.lit("")), "\n")
    lines = F.when(alone, F.concat(F.array(found), body)).otherwise(
        F.concat(F.array(F.concat(F.coalesce(found, F.lit("")), body[0])), F.slice(body, 2, 1 << 30)))
    lines = F.when(bare, F.concat(lines, F.array(F.lit("")))).otherwise(lines)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", lines.alias("lines"))


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from all conversations as transcripts; the model learns
    from those whose crc32(conv_id as text) mod 4 is not 1."""
    turns = transcripts(table(spark, sf_dir, "conversations"))
    hmm = chat.fit(turns.where(id_bucket("conv_id", 4) != 1))
    lines = turns.select("conv_id", F.col("turn").alias("major"), F.posexplode("lines").alias("minor", "line"))
    return chat.parse(lines, hmm)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.report(table(spark, sf_dir, "documents"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the corpus model."""
    return lm.score(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 128 to 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return neardup.link(table(spark, sf_dir, "documents"))


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents; clean documents have no row."""
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth, against all."""
    return ann.search(table(spark, sf_dir, "embeddings"))


def op9_arrow_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to Arrow files and read back from them."""
    return arrow_store.encode_to_files(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of all vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations after damage."""
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by their 3-word shingles."""
    return ngram_join.link(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_chat, op2_pii, op3_lm, op4_packing, op5_neardup, op6_decontam, op7_toxicity, op8_ann, op9_arrow_store,
                                                     op10_langid, op11_whitening, op12_repair, op13_ngram_join)}

# Queries that DuckDB can express.
ORACLE_SQL: dict[str, str] = {"op12_repair": oracles.repair_sql(), "op13_ngram_join": oracles.NGRAM_JOIN}
