"""Toxicity by compression distance (operator 7).

Two zstandard dictionaries are trained on labelled text, one on toxic and one on
ordinary documents: each holds the stretches of its class whose character
n-grams are over-represented against the other beyond chance, the commonest
last, and both are made equally long.  (Dictionaries that the library's own trainer picks
spend their bytes on what both classes share; the differences then drown in
noise.)  Each window of a text (some words, lower-cased, punctuation as spaces)
is compressed with either; what the toxic dictionary saves is the distance.
The savings per length and the two largest are calibrated to a probability by a
logistic fit on labelled documents that no dictionary has seen.

What is over-represented differs by language, so the labelled texts are first
rid of near copies and put into kinds by their letters alone (k-means over trigram shares, near
centres joined), and each kind with enough toxic texts has its own dictionaries
and calibration; the others share those of all texts.  Calibration is
cross-fitted: dictionaries of one half score the other, and those in use are
trained on both.

Labels come from a bounded sample: at most SAMPLE_DOCS documents of each class
(least hash of the id), whatever their length.  Of repeated rows of an id the
text with the least hash counts.  Scores cover every window of every text.

Null text scores as empty text, an empty or word-free text as one empty window.
Repeated labels of a document: toxic if any says so.  Fewer than two labelled
documents of a class: every score is 0.  Repeated rows score alike; extra columns pass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.common import documents, id_bucket, ready
from stockflow.llm.words import shingle_sets

SAMPLE_DOCS = 2400
THRESHOLD = 0.7
GRAM = 6
# An n-gram of a class: in so many standard errors more of its documents than of the other's (in LEAST_DOCS at least),
# and so much more often for their length (natural log of the ratio).
SIGNIFICANT, LEAST_ODDS, LEAST_DOCS = 5.0, 1.0, 3
# Kinds of texts: hashed trigrams, centres at first, how alike (cosine) two centres are one, toxic texts that a kind needs.
TRIGRAMS, CENTRES, ALIKE, LEAST_TOXIC = 1024, 16, 0.75, 8
DICTIONARY_BYTES = 16_384
# Bytes of text in which an n-gram's occurrences are counted, and the most that count.
STRETCH, MOST = 1024, 4.0
# Least shingle hashes by which copies are known.
COPY_HASHES = 16
# Words in a window.
WINDOW = 12
# Opens every window and closes both dictionaries.  A block that saves too little is stored as it is; this match lifts
# every window over that bar, so that any further one shows.
OPENING = b"\1\2\3\4\5\6\7" * 4
_BREAKS = re.compile(r"[\W_]+")


def words(text: str | None) -> list[str]:
    return _BREAKS.sub(" ", (text or "").lower()).split()


def windows(tokens: list[str], size: int = WINDOW) -> list[bytes]:
    return [OPENING + f" {' '.join(tokens[k:k + size])} ".encode() for k in range(0, len(tokens), size)] or [OPENING]


def _flat(text: str) -> bytes:
    return f" {' '.join(words(text))} ".encode()


def _codes(flat: bytes) -> np.ndarray:
    """The n-gram at each place as a 32-bit hash (0 unless within one word and the spaces around it)."""
    data = np.frombuffer(flat, dtype=np.uint8)
    n = max(0, len(data) - GRAM + 1)
    code, broken = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    for k in range(GRAM):
        code = code << np.uint64(8) | data[k:k + n].astype(np.uint64)
        if 0 < k < GRAM - 1:
            broken |= data[k:k + n] == 32
    code = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
    code[broken] = 0
    return code


@lru_cache(maxsize=4 * SAMPLE_DOCS)
def _coded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct n-grams, and how often each occurs in STRETCH bytes, so that a
    long text does not count for holding everything."""
    code = _codes(_flat(text))
    distinct, times = np.unique(code[code > 0], return_counts=True)
    return distinct, np.minimum(times * (STRETCH / max(len(code), STRETCH // 4)), MOST).astype(np.float32)


def pieces(own: list[str], other: list[str]) -> bytes:
    """Stretches of ``own`` made of n-grams over-represented against ``other``,
    rarest first (zstandard reaches the end of a dictionary most cheaply)."""
    def shown(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, at = np.unique(np.concatenate([_coded(t)[0] for t in texts]), return_inverse=True)
        rate = np.bincount(at, weights=np.concatenate([_coded(t)[1] for t in texts]), minlength=len(codes))
        return codes, np.bincount(at, minlength=len(codes)), rate

    (here, n, rate), (there, *others) = shown(own), shown(other)
    common = np.minimum(np.searchsorted(there, here), max(0, len(there) - 1))
    m, rate_there = (np.where(there[common] == here, x[common], 0) if len(there) else np.zeros(len(here)) for x in others)
    a, b = len(own), len(other)
    both = (n + m) / (a + b)
    error = np.sqrt(both * (1 - both) * (1 / a + 1 / b))
    typical = ((n >= LEAST_DOCS) & (n / a - m / b >= SIGNIFICANT * error)
               & ((rate + 0.5) / (a + 1) >= np.exp(LEAST_ODDS) * (rate_there + 0.5) / (b + 1)))
    marked = here[typical]
    found: Counter[bytes] = Counter()
    for t in own:
        flat = _flat(t)
        edges = np.diff(np.concatenate(([0], np.isin(_codes(flat), marked).astype(np.int8), [0])))
        for start, end in zip(np.flatnonzero(edges > 0).tolist(), np.flatnonzero(edges < 0).tolist(), strict=True):
            found[flat[start:end + GRAM - 1]] += 1
    kept, size = [], 0
    for p, _ in sorted(found.items(), key=lambda f: (-f[1], f[0])):
        if size + len(p) < DICTIONARY_BYTES:
            kept.append(p)
            size += len(p) + 1
    return b"\0".join([*reversed(kept), b""])


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents, of one length."""
    both = [pieces(ordinary, toxic), pieces(toxic, ordinary)]
    size = max(map(len, both))
    return tuple(d.rjust(size, b"\0") + OPENING for d in both)


class Scorer:
    """Compression features and their calibrated probability."""

    def __init__(self, dictionaries: tuple[bytes, bytes], weights: list[float] | None = None):
        import zstandard as zs

        # Raw literals (fast strategy with a target length): a match saves its own length, nothing shifts a code table.
        how = zs.ZstdCompressionParameters(window_log=18, hash_log=17, chain_log=16, search_log=1, min_match=GRAM,
                                           target_length=1, strategy=zs.STRATEGY_FAST, write_content_size=0,
                                           write_checksum=0, write_dict_id=0)
        self.ordinary, self.toxic = (
            zs.ZstdCompressor(dict_data=zs.ZstdCompressionDict(d, dict_type=zs.DICT_TYPE_RAWCONTENT),
                              compression_params=how).compress for d in dictionaries)
        self.weights = None if weights is None else np.array(weights)

    def features(self, text: str | None) -> list[float]:
        parts = windows(words(text))
        saved = np.array([len(self.ordinary(w)) - len(self.toxic(w)) for w in parts], dtype=float)
        best = np.sort(saved)[-2:]
        return [1.0, 100 * saved.sum() / (sum(map(len, parts)) + 200), np.log1p(max(best[-1], 0)), np.log1p(max(best[0], 0))]

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        z = np.clip(np.array([self.features(t) for t in texts]) @ self.weights, -500, 500)
        return 1 / (1 + np.exp(-z))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method; ``weight`` is how many documents one stands for."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def shares(text: str | None) -> np.ndarray:
    """Square roots of a text's shares of letter trigrams: a vector of length 1 (or 0)."""
    data = np.frombuffer(f" {' '.join(words(text))} ".encode(), dtype=np.uint8).astype(np.uint32)
    code = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    n = np.bincount(code >> np.uint32(22), minlength=TRIGRAMS).astype(np.float32)
    return np.sqrt(n / max(n.sum(), 1))


def centres(x: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Centres of the kinds of texts with trigram shares ``x``."""
    unit = lambda c: c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    c = x[:1]
    while len(c) < min(CENTRES, len(x)):   # farthest first
        c = np.vstack([c, x[(x @ c.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = unit(np.vstack([x[own == k].mean(axis=0) if (own == k).any() else c[k] for k in range(len(c))]))
    size = np.bincount((x @ c.T).argmax(axis=1), minlength=len(c))
    while len(c) > 1:   # join the two nearest as long as they are alike
        near = np.triu(c @ c.T, 1)
        a, b = np.unravel_index(near.argmax(), near.shape)
        if near[a, b] < ALIKE:
            break
        c[a] = c[a] * size[a] + c[b] * size[b]
        size[a] += size[b]
        c, size = unit(np.delete(c, b, axis=0)), np.delete(size, b)
    return c


def originals(texts: list[str]) -> list[str]:
    """The texts without near copies of earlier ones (half of their least shingle
    hashes in common): what many copies share is not typical of a class."""
    seen: dict[int, list[int]] = {}
    kept = []
    for text, shingles in zip(texts, shingle_sets([" ".join(words(t)) for t in texts], 3), strict=True):
        least = shingles[:COPY_HASHES].tolist()
        common = Counter(k for h in least for k in seen.get(h, ()))
        if not common or 2 * max(common.values()) < len(least):
            for h in least:
                seen.setdefault(h, []).append(len(kept))
            kept.append(text)
    return kept


def train(toxic: list[str], ordinary: list[str], stands_for: tuple[float, float]) -> tuple[tuple[bytes, bytes], list[float]]:
    """(dictionaries, weights), the weights from texts that the dictionaries of the
    other half score.  An ordinary or toxic text ``stands_for`` so many."""
    x, y = [], []
    for half in (0, 1):
        scorer = Scorer(train_dictionaries(toxic[half::2], ordinary[half::2]))
        for c, texts in ((1, toxic), (0, ordinary)):
            rest = texts[1 - half::2]
            x += [scorer.features(t) for t in rest]
            y += [float(c)] * len(rest)
    y = np.array(y)
    return train_dictionaries(toxic, ordinary), calibrate(np.array(x), y, np.array(stands_for)[y.astype(int)]).tolist()


class Model:
    """What :func:`fit` learned: centres of the kinds, and the dictionaries and
    weights of each; some hundred kilobytes, sent with the tasks."""

    def __init__(self, kinds: np.ndarray | None, trained: list[tuple[tuple[bytes, bytes], list[float]]]):
        self.kinds, self.trained = kinds, trained
        self.scorers: list[Scorer] | None = None

    def __getstate__(self) -> tuple:
        return self.kinds, self.trained

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(texts))
        if self.scorers is None:
            self.scorers = [Scorer(*t) for t in self.trained]
        out = np.empty(len(texts))
        kind = [int((shares(t) @ self.kinds.T).argmax()) for t in texts]
        for k in set(kind):
            at = [j for j, own in enumerate(kind) if own == k]
            out[at] = self.scorers[k].score([texts[j] for j in at])
        return out

    def score(self, text: Column) -> Column:
        """Probability (0 to 1) that a text is toxic."""
        shared = _session().sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(shared.value.scores(texts.tolist()), dtype=float)

        return toxicity(text)


def _session() -> SparkSession:
    return SparkSession.getActiveSession()


def learn(toxic: list[str], ordinary: list[str], stands_for: tuple[float, float] = (1.0, 1.0)) -> Model:
    """The model of labelled texts; an ordinary or toxic one ``stands_for`` so many of the table."""
    toxic, ordinary = originals(toxic), originals(ordinary)
    if min(len(toxic), len(ordinary)) < 2:
        return Model(None, [])
    kinds = centres(np.array([shares(t) for t in [*ordinary, *toxic]]))
    parts = [[[t for t in texts if int((shares(t) @ kinds.T).argmax()) == k] for k in range(len(kinds))] for texts in (ordinary, toxic)]
    whole, trained = train(toxic, ordinary, stands_for), []
    for own_ordinary, own_toxic in zip(*parts, strict=True):
        apart = len(own_toxic) >= LEAST_TOXIC and len(own_ordinary) >= LEAST_TOXIC
        trained.append(train(own_toxic, own_ordinary, stands_for) if apart else whole)
    _coded.cache_clear()
    return Model(kinds, trained)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from labelled documents outside ``held_out``.

    Only ids meet the labels; the texts of at most 2 x ``sample_docs`` chosen
    documents then come to the driver.
    """
    ready(docs.sparkSession)
    d = documents(docs)
    marks = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    fit_for = d.where(~held_out & F.col("text").isNotNull()).select("doc_id").join(marks, "doc_id")
    fit_for = fit_for.distinct()
    rank = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [fit_for.where(F.col("toxic") == c).orderBy(*rank).limit(sample_docs) for c in (0, 1)]
    labelled = {r["toxic"]: r["count"] for r in fit_for.groupBy("toxic").count().collect()}
    texts = (d.where(F.col("text").isNotNull())
             .join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")   # at most 2 x sample_docs ids
             .groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
             .orderBy(*rank).collect())
    by_class = [[r.text for r in texts if r.toxic == c] for c in (0, 1)]
    return learn(by_class[1], by_class[0], tuple(labelled.get(c, 0) / max(1, len(by_class[c])) for c in (0, 1)))


def held_out_third(column: str = "doc_id") -> Column:
    return id_bucket(column, 3) == 1


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, held_out_third())
    scored = documents(docs).select("doc_id", held_out_third().alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, all columns kept."""
    model = fit(docs, labels, held_out_third())
    return docs.where(model.score(F.col("text").cast("string")) < THRESHOLD)
