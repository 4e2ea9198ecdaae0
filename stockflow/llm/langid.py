"""Language identification as a mixture of languages (operator 10).

Every learned language has a distribution over hashed character n-grams (three
code points, lower-cased, all but letters as one space).  A text is a mixture:
expectation-maximisation estimates the proportion of each language from the
likelihoods of the text's n-grams.  Languages then leave the set one by one,
least proportion first, while that raises the penalised likelihood; the
prediction is the largest proportion left.

The distributions are learned from a sample of every labelled language: its
documents, of any length, are kept by a hash of their id and text so that about
SAMPLE_DOCS remain (all of them for rarer languages).  Every distinct label is a
language: it costs 0.25 MB at the driver and in each worker, and prediction time
grows with the square of their number, so a label column should be clean.

Null text, or text without a letter: ``und``, score 0.  No labelled document at
all: the same.  Repeated rows get equal results; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import id_bucket, ready

SAMPLE_DOCS = 1500
BITS = 15
SMOOTHING = 0.1
EM_STEPS = 12
# Penalty of a further language: so many times half the log of the number of n-grams.
PENALTY = 4.0
_BREAKS = re.compile(r"[\W\d_]+")
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def grams(text: str | None) -> np.ndarray:
    """Hashed n-grams of a text; empty if it has no letter."""
    s = _BREAKS.sub(" ", (text or "").lower()).strip()
    if not any(c.isalpha() for c in s):
        return np.empty(0, dtype=np.int64)
    c = np.frombuffer(f" {s} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    h = c[:-2] * _K[0] + c[1:-1] * _K[1] + c[2:] * _K[2]
    return ((h ^ (h >> np.uint64(29))) * _K[0] >> np.uint64(64 - BITS)).astype(np.int64)


def mixture(p: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, float]:
    """Proportions by EM, and the log likelihood.  p: n-grams x languages."""
    share, total = np.full(p.shape[1], 1 / p.shape[1]), counts.sum()
    for _ in range(steps if p.shape[1] > 1 else 0):
        joint = p * share
        share = counts @ (joint / joint.sum(axis=1, keepdims=True)) / total
    return share, float(counts @ np.log(p @ share))


def infer(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(languages kept, their proportions) by penalised likelihood."""
    kept = np.arange(p.shape[1])
    penalty = PENALTY * 0.5 * np.log(counts.sum() + 1)
    share, fitted = mixture(p, counts)
    while len(kept) > 1:
        fewer = np.delete(kept, share.argmin())
        share_fewer, fitted_fewer = mixture(p[:, fewer], counts)
        if fitted_fewer < fitted - penalty:
            break
        kept, share, fitted = fewer, share_fewer, fitted_fewer
    return kept, share


class Model:
    """N-gram probabilities of each language (2^BITS doubles a language)."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        c = counts + SMOOTHING
        self.p = (c / c.sum(axis=1, keepdims=True)).T.copy()   # n-gram x language

    def predict(self, text: str | None) -> tuple[str, float, str]:
        g = grams(text)
        if not len(g) or not self.languages:
            return "und", 0.0, ""
        u, n = np.unique(g, return_counts=True)
        kept, share = infer(self.p[u], n.astype(float))
        order = np.lexsort((kept, -share))
        mix = ",".join(f"{self.languages[kept[k]]}:{share[k]:.3f}" for k in order)
        return self.languages[kept[order[0]]], float(min(share[order[0]], 1.0)), mix


def fit(docs: DataFrame, held_out: Column, sample_docs: int = SAMPLE_DOCS) -> Model:
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.col("lang").cast("string").alias("lang"))
    d = d.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = d.groupBy("lang").count().collect()   # a row per language
    if not known:
        return Model([], np.ones((1, 1 << BITS)))
    share = F.create_map(*[F.lit(x) for r in known for x in (r["lang"], min(1.0, sample_docs / r["count"]))])
    lucky = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                sums.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
                sums[lang] += np.bincount(grams(text), minlength=1 << BITS)
        rows = [(lang, int(k), int(c[k])) for lang, c in sums.items() for k in np.flatnonzero(c)]
        yield pd.DataFrame(rows, columns=["lang", "gram", "n"])

    counted = (d.where(lucky).select("lang", "text")
               .mapInPandas(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    languages = sorted(r["lang"] for r in known)
    row = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((len(languages), 1 << BITS))
    for r in counted.collect():   # at most languages x 2^BITS rows
        counts[row[r["lang"]], r["gram"]] = r["n"]
    return Model(languages, counts)


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: predicted language, its proportion, the mixture."""
    spark = docs.sparkSession
    ready(spark)
    held_out = id_bucket("doc_id", 4) == 2
    shared = spark.sparkContext.broadcast(fit(docs, held_out))

    @F.pandas_udf("lang_pred string, score double, languages string")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts.tolist()], columns=["lang_pred", "score", "languages"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
                        predicted(F.col("text").cast("string")).alias("p")).select("doc_id", "held_out", "p.*"))
