"""Corpus language model by deleted interpolation (operator 3).

Bigram, unigram and uniform probabilities are maximum-likelihood estimates from
the training documents, mixed with weights that depend on how often the context
was seen (one bucket for each power of two).  The weights are learned by
expectation-maximisation on held-out counts: one fold of the training documents
is set aside, the estimates come from the other folds, and the probabilities of
the fold's tokens are collected on a logarithmic grid, which bounds what the
driver iterates on.  With the weights fixed, all training documents are counted
again in full and every document is scored.

Counting: documents are cut into blocks where they lie; a block sends each of
its distinct n-grams (64-bit hashes, sorted, with counts) once to the n-gram's
part, packed in arrays, and gets the corpus counts back in the same order.  So
a frequent word costs one entry a block, whatever its share of the corpus, and
no vocabulary is ever in one place.  Blocks and replies are stored in the
shared folder.

Tokens: see :mod:`stockflow.llm.words`, then one end token; the end also opens
the next text as its context.  Null text is empty: the end alone.  Repeated
rows are documents each; null ids count as empty id text.  No training token at
all: every probability is the uniform one.  An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from stockflow.llm.common import column_values, documents, id_bucket, ready, stored
from stockflow.llm.words import mix, word_hashes

BLOCK_TOKENS = 1_500_000
PART_TOKENS = 2_000_000
GRID = 4   # cells for each power of two of a probability
BUCKETS = 40
EM_STEPS, PRIOR = 60, 50.0
_END = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
# Folds: the documents of HELD_OUT are never learned from; those of DEV give the held-out counts.
FOLDS, HELD_OUT, DEV = 5, 1, 2


def _squeeze(a: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    import zstandard as zs

    planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T)
    return zs.ZstdCompressor(level=1).compress(planes.tobytes())


def _expand(b: bytes, kind: type) -> np.ndarray:
    import zstandard as zs

    raw = np.frombuffer(zs.ZstdDecompressor().decompress(b), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


BLOCK = "block long, n_tokens long, words binary, tokens binary, sizes binary, folds binary, doc_ids binary, no_id binary"


class _Cutter:
    """Gathers documents of one kind until they fill a block."""

    def __init__(self, first: int):
        self.number = first
        self.clear()

    def clear(self) -> None:
        self.hashes, self.sizes, self.folds, self.ids, self.held = [], [], [], [], 0

    def add(self, doc_id: int | None, fold: int, hashes: np.ndarray) -> None:
        self.hashes += [hashes, np.array([_END])]
        self.sizes.append(len(hashes) + 1)
        self.folds.append(fold)
        self.ids.append(doc_id)
        self.held += self.sizes[-1]

    def block(self) -> pa.RecordBatch:
        words, tokens = np.unique(np.concatenate(self.hashes), return_inverse=True)
        missing = np.array([i is None for i in self.ids])
        row = [self.number, len(tokens), np.diff(words, prepend=np.uint64(0)), tokens.astype(np.uint32),
               np.array(self.sizes, dtype=np.uint32), np.array(self.folds, dtype=np.uint8),
               np.array([i or 0 for i in self.ids], dtype=np.int64), missing.astype(np.uint8)]
        self.clear()
        self.number += 2
        return pa.RecordBatch.from_arrays(
            [pa.array([x if k < 2 else _squeeze(x)], pa.int64() if k < 2 else pa.binary()) for k, x in enumerate(row)],
            names=[c.split()[0] for c in BLOCK.split(", ")])


def blocks(docs: DataFrame) -> DataFrame:
    """Documents as word numbers, a block of about BLOCK_TOKENS tokens a row.
    Odd block numbers hold the fold set aside, even ones all others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        cutters = (_Cutter(first), _Cutter(first + 1))
        for batch in batches:
            h, at = word_hashes(column_values(batch, "text"))
            for k, (doc_id, fold) in enumerate(zip(column_values(batch, "doc_id"), column_values(batch, "fold"), strict=True)):
                cutter = cutters[fold == DEV]
                cutter.add(doc_id, fold, h[at[k]:at[k + 1]])
                if cutter.held >= BLOCK_TOKENS:
                    yield cutter.block()
        for cutter in cutters:
            if cutter.ids:
                yield cutter.block()

    d = documents(docs).select("doc_id", "text", id_bucket("doc_id", FOLDS).alias("fold"))
    return d.mapInArrow(run, BLOCK)


class _Block:
    """A block's distinct words and bigrams, both in the order of their hashes."""

    def __init__(self, row: dict):
        self.words = np.cumsum(_expand(row["words"], np.uint64), dtype=np.uint64)
        self.tokens = _expand(row["tokens"], np.uint32).astype(np.int64)
        self.sizes = _expand(row["sizes"], np.uint32).astype(np.int64)
        self.fold = np.repeat(_expand(row["folds"], np.uint8), self.sizes)
        end = int(np.searchsorted(self.words, _END))
        before = np.concatenate(([end], self.tokens[:-1]))   # a text follows the end of the one before, and so the first
        pairs, self.pair_of = np.unique(before * len(self.words) + self.tokens, return_inverse=True)
        first, second = pairs // len(self.words), pairs % len(self.words)
        h = mix(self.words[first] * _PAIR + self.words[second])
        order = np.argsort(h, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.pairs, self.context, self.word, self.pair_of = h[order], first[order], second[order], rank[self.pair_of]

    def counts(self, index: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences in the counted folds, and in the one set aside."""
        kept = (self.fold != HELD_OUT) & (self.fold != DEV)
        return (np.bincount(index[kept], minlength=n).astype(np.uint32),
                np.bincount(index[self.fold == DEV], minlength=n).astype(np.uint32))


COUNTS = "kind int, part int, block long, hashes binary, kept binary, aside binary"
REPLY = "kind int, part int, block long, kept binary, aside binary, types_kept long, types_all long, n_kept long, n_all long"


def _send(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = _Block(row)
                for kind, hashes, index in ((0, b.words, b.tokens), (1, b.pairs, b.pair_of)):
                    kept, aside = b.counts(index, len(hashes))
                    part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                    cuts = np.searchsorted(part, np.arange(parts + 1))
                    some = [p for p in range(parts) if cuts[p + 1] > cuts[p]]
                    cut = [slice(cuts[p], cuts[p + 1]) for p in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(some), pa.int32()), pa.array(some, pa.int32()),
                         pa.array([row["block"]] * len(some), pa.int64()),
                         pa.array([_squeeze(np.diff(hashes[c], prepend=np.uint64(0))) for c in cut], pa.binary()),
                         pa.array([_squeeze(kept[c]) for c in cut], pa.binary()),
                         pa.array([_squeeze(aside[c]) for c in cut], pa.binary())],
                        names=[c.split()[0] for c in COUNTS.split(", ")])
    return run


def _sum(rows: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of one part's n-grams, back to each block in its order."""
    hashes = [np.cumsum(_expand(b, np.uint64), dtype=np.uint64) for b in rows["hashes"]]
    found, at = np.unique(np.concatenate(hashes), return_inverse=True)
    kept, aside = (np.bincount(at, weights=np.concatenate([_expand(b, np.uint32) for b in rows[c]]), minlength=len(found)).astype(np.uint32)
                   for c in ("kept", "aside"))
    ends = np.cumsum([0, *map(len, hashes)])
    out = rows[["kind", "part", "block"]].copy()
    out["kept"] = [_squeeze(kept[at[a:z]]) for a, z in zip(ends[:-1], ends[1:], strict=True)]
    out["aside"] = [_squeeze(aside[at[a:z]]) for a, z in zip(ends[:-1], ends[1:], strict=True)]
    total = kept.astype(np.int64) + aside
    for c, v in (("types_kept", (kept > 0).sum()), ("types_all", (total > 0).sum()), ("n_kept", kept.sum(dtype=np.int64)), ("n_all", total.sum())):
        out[c] = [int(v)] + [0] * (len(out) - 1)
    return out


def _counted(row: pd.DataFrame, replies: pd.DataFrame) -> tuple[_Block, dict]:
    b = _Block(row.iloc[0].to_dict())
    got = {}
    for kind in (0, 1):
        own = replies[replies["kind"] == kind].sort_values("part")
        for c in ("kept", "aside"):
            got[kind, c] = np.concatenate([_expand(x, np.uint32) for x in own[c]]).astype(np.float64)
    return b, got


def _probabilities(b: _Block, words: np.ndarray, pairs: np.ndarray, n: int, types: int) -> tuple:
    """Of each distinct bigram: context bucket, bigram and unigram estimate; the uniform one."""
    # As a context a word occurs as often as a token: every text's end opens the next.
    seen = words[b.context]
    p2 = np.divide(pairs, seen, out=np.zeros(len(pairs)), where=seen > 0)
    p1 = words[b.word] / max(n, 1)
    return np.minimum(np.log2(seen + 1).astype(np.int64), BUCKETS - 1), p2, p1, 1.0 / (types + 1)


def _cell(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, 1 + np.rint(-GRID * np.log2(np.where(p > 0, p, 1))), 0).astype(np.int32)


def weights(cells: pd.DataFrame, p0: float) -> np.ndarray:
    """BUCKETS x (bigram, unigram, uniform) by EM; a bucket starts from, and is
    drawn towards, the weights of all buckets together."""
    p = np.column_stack([np.where(cells[c] > 0, 2.0 ** (-(cells[c] - 1) / GRID), 0) for c in ("q2", "q1")] + [np.full(len(cells), p0)])
    n, bucket = cells["n"].to_numpy(dtype=float), cells["bucket"].to_numpy()

    def fit(which: np.ndarray, start: np.ndarray, prior: float) -> np.ndarray:
        w = start
        for _ in range(EM_STEPS):
            share = p[which] * w
            share /= share.sum(axis=1, keepdims=True)
            w = n[which] @ share + prior * start
            w /= w.sum()
        return w

    overall = fit(np.ones(len(cells), dtype=bool), np.array([0.4, 0.4, 0.2]), 1e-3) if len(cells) else np.array([0.4, 0.4, 0.2])
    out = np.array([fit(bucket == k, overall, PRIOR) if (bucket == k).any() else overall for k in range(BUCKETS)])
    out[0, 0] = 0   # an unseen context has no bigram estimate
    return out / out.sum(axis=1, keepdims=True)


def score(docs: DataFrame) -> DataFrame:
    """One row per document: sizes, the additive unigram score and the model's."""
    spark = docs.sparkSession
    ready(spark)
    cut = stored(blocks(docs), "blocks")
    tokens = cut.agg(F.sum("n_tokens")).first()[0]
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    if not tokens:
        return spark.createDataFrame([], out)
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = max(tasks, -(-tokens // PART_TOKENS))
    sent = cut.mapInArrow(_send(parts), COUNTS)
    replies = stored(sent.groupBy("kind", "part").applyInPandas(_sum, REPLY), "counts")
    types_kept, types_all, n_kept, n_all = replies.where("kind = 0").agg(
        *[F.sum(c) for c in ("types_kept", "types_all", "n_kept", "n_all")]).first()

    def aside(row: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        b, got = _counted(row, reply)
        bucket, p2, p1, _ = _probabilities(b, got[0, "kept"], got[1, "kept"], n_kept, types_kept)
        n = np.bincount(b.pair_of[b.fold == DEV], minlength=len(p2))
        use = n > 0
        found = pd.DataFrame({"bucket": bucket[use].astype(np.int32), "q2": _cell(p2[use]), "q1": _cell(p1[use]), "n": n[use]})
        return found.groupby(["bucket", "q2", "q1"], as_index=False)["n"].sum()

    def scores(row: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        b, got = _counted(row, reply)
        words, pairs = (got[k, "kept"] + got[k, "aside"] for k in (0, 1))
        bucket, p2, p1, p0 = _probabilities(b, words, pairs, n_all, types_all)
        w = lam[bucket]
        model = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0)
        base = np.log10((words + 0.5) / (n_all + 0.5 * (types_all + 1)))
        start = np.cumsum(b.sizes) - b.sizes
        row = row.iloc[0]
        ids = pd.array(_expand(row["doc_ids"], np.int64), dtype="Int64")
        ids[_expand(row["no_id"], np.uint8) > 0] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": _expand(row["folds"], np.uint8) == HELD_OUT, "n_tokens": b.sizes,
            "n_known": np.add.reduceat((words > 0)[b.tokens].astype(np.int64), start), "train_tokens": n_all,
            "base_score": np.add.reduceat(base[b.tokens], start), "score": np.add.reduceat(model[b.pair_of], start)})

    def own(which: str) -> PandasCogroupedOps:
        mine = replies.where(which).select("block", "kind", "part", "kept", "aside")
        return cut.where(which).groupBy("block").cogroup(mine.groupBy("block"))

    cells = (own("block % 2 = 1").applyInPandas(aside, "bucket int, q2 int, q1 int, n long")
             .groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n")).toPandas())   # at most BUCKETS x grid x grid rows
    lam = weights(cells.sort_values(["bucket", "q2", "q1"]), 1.0 / (types_kept + 1))
    return own("true").applyInPandas(scores, out)
