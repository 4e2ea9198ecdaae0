"""Benchmark passages in documents by q-gram lemma filtering (operator 6).

Texts are compared as lower-cased letters and digits, anything else being one
space.  A document matches an item where any window of SEGMENT characters of the
item, at whatever offset (the whole of a shorter item), is within the window's
budget of edits, EDIT_RATE of its length, of a passage.  By the q-gram lemma such
a passage shares at least  length + 1 - q (budget + 1)  character q-grams with
the window, on diagonals no further apart than the budget.  So: positions whose
q-gram occurs in the benchmark are marked; stretches with too few marks are
dropped; in the rest, shared q-grams are counted for each item in overlapping
bands of diagonals; where the grams of a band reach the bound within some window,
all such windows are verified by banded alignment.  Neighbouring windows of a band
are first aligned by the characters they all have: above the budget there, none of
them is within it; else each half of them is tried.  So items that open with one
phrase cost one alignment a place, not one a window.  All of this is lossless.

The benchmark, without repeated rows, is sent to the tasks in blocks of about
BLOCK_CHARS characters (a hash of the row decides), one pass over the documents
for each.

Items below LEAST_CHARS characters are too short for edits: they match unchanged,
from a word's start to a word's end (a letter or digit and anything else part
words, so within a script without spaces they match a whole run of letters).

Null texts count as empty; null items and items without a letter or digit match
nothing.  Repeated rows of documents are searched each; several items may match
one document.  Either table empty: no hits.
Other columns are not read; ``clean`` passes them on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import column_values, documents, ready, slabs

Q = 8
SEGMENT = 80
EDIT_RATE = 0.075
LEAST_CHARS = 24
BLOCK_CHARS = 4_000_000
ALIGNED = 10_000   # windows aligned at a time
RUN = 32   # neighbouring windows that are first tried as one
ENTRIES = 1 << 20   # shared q-grams counted at a time, or those of the shortest stretch of text that holds a passage
SLAB = 1 << 18   # characters of texts searched at a time
_B1 = np.uint64(0x9E3779B97F4A7C15)
_B2, _B4 = (np.uint64(pow(int(_B1), k, 1 << 64)) for k in (2, 4))
_TABLE_BITS = 20
_SEPARATOR = 0x110000   # above every code point


@lru_cache(maxsize=1)
def _kept() -> np.ndarray:
    """Whether a code point is a letter or digit."""
    return np.array([chr(c).isalnum() for c in range(0x110000)], dtype=bool)


def normal(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(code points compared, their positions in the text)."""
    t = text or ""
    low = t.lower()
    if len(low) != len(t):   # a few letters lower to two characters
        low = "".join(x if len(x := c.lower()) == 1 else c for c in t)
    c = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    own = _kept()[c]
    keep = own.copy()
    keep[1:] |= own[:-1]   # the first other character after a letter stands for the gap
    at = np.flatnonzero(keep)
    return np.where(own[at], c[at], 32).astype(np.uint64), at


def qgrams(c: np.ndarray) -> np.ndarray:
    """Hashes of all windows of 8 code points."""
    if len(c) < Q:
        return np.empty(0, dtype=np.uint64)
    two = c[:-1] * _B1 + c[1:]
    four = two[:-2] * _B2 + two[2:]
    return four[:-4] * _B4 + four[4:]


def _whole(c: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` code points from each place."""
    h = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        h = h * _B1 + c[at + k]
    return h


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(31))) * _B1 >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def aligned(patterns: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, starts, ends) of the best place of each pattern (a row) in its text
    (a row), on the diagonals that the text is longer by, plus one.  Of equally
    good places the one that starts last, then ends first.  Cells hold edits and
    start in one number; rows of the alignment go over the pattern."""
    m, width = patterns.shape[1], texts.shape[1] - patterns.shape[1] + 1
    most = (m + 2 * width + 2) * (width + 1)
    edit = np.int16(width + 1) if most < 1 << 15 else np.int32(width + 1) if most < 1 << 31 else np.int64(width + 1)
    ramp = (np.arange(width) * edit).astype(edit.dtype)[:, None]
    p, t = np.ascontiguousarray(patterns.T), np.ascontiguousarray(texts.T)
    key = np.tile(-np.arange(width, dtype=edit.dtype)[:, None], (1, len(patterns)))
    for i in range(m):
        new = key + (t[i:i + width] != p[i]) * edit
        np.minimum(new[:-1], key[1:] + edit, out=new[:-1])
        new -= ramp   # insertions run along the diagonals
        key = np.minimum.accumulate(new, axis=0, out=new)
        key += ramp
    end = key.argmin(axis=0)
    best = key[end, np.arange(key.shape[1])].astype(np.int64)
    cost = -(-best // int(edit))
    return cost, cost * int(edit) - best, end + m


def distance(pattern: np.ndarray, text: np.ndarray, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``pattern`` in the whole of ``text``,
    or nothing above ``budget``."""
    m, n = len(pattern), len(text)
    around = np.full(m, _SEPARATOR, dtype=np.uint64)
    cost, start, end = (int(x[0]) for x in aligned(pattern[None], np.concatenate([around, text, around])[None]))
    return (cost, min(max(start - m, 0), n), min(max(end - m, 0), n)) if cost <= budget else None


class Index:
    """Items of the benchmark and their q-grams."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.item, texts = [], []
        short: dict[int, dict[int, list[tuple[int, np.ndarray]]]] = {}   # length -> hash -> items
        for item, text in items:
            c, _ = normal(text)
            if len(c) and c[-1] == 32:
                c = c[:-1]
            if len(c) >= LEAST_CHARS:
                self.item.append(item)
                texts.append(c)
            elif len(c):
                short.setdefault(len(c), {}).setdefault(int(_whole(c, np.zeros(1, dtype=np.int64), len(c))[0]), []).append((item, c))
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.window = np.minimum(self.length, SEGMENT)
        self.budget = (self.window * EDIT_RATE).astype(np.int64)
        self.bound = np.maximum(1, self.window + 1 - Q * (self.budget + 1))
        self.text = np.concatenate([*texts, np.empty(0, dtype=np.uint64)]).astype(np.uint32)
        self.begin = np.cumsum([0, *self.length])
        grams = [qgrams(t) for t in texts]
        flat = np.concatenate([*grams, np.empty(0, dtype=np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.hash = flat[order]
        self.owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.place = np.concatenate([*[np.arange(len(g)) for g in grams], np.empty(0, dtype=np.int64)])[order].astype(np.int64)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[_slot(self.hash)] = True
        self.short = {n: (np.array(sorted(of), dtype=np.uint64), of) for n, of in short.items()}

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text: (item, start, end, edits) of its passages, in code points."""
        return [hits for part in slabs(texts, SLAB) for hits in self._search(part)]

    def _search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        if not len(self.hash) and not self.short:
            return found
        norms = [normal(t) for t in texts]
        gap = np.full(SEGMENT + Q + int(SEGMENT * EDIT_RATE) * 2, _SEPARATOR, dtype=np.uint64)
        c = np.concatenate([gap] + [x for n, _ in norms for x in (n, gap)])
        begins = len(gap) + np.cumsum([0, *[len(x) + len(gap) for x, _ in norms]])
        hits: list[list[tuple[int, int, int, int, int]]] = [[] for _ in texts]
        for item, at, end in self.unchanged(c):
            doc = int(np.searchsorted(begins, at, side="right")) - 1
            where = norms[doc][1]
            hits[doc].append((item, int(where[at - begins[doc]]), int(where[end - 1 - begins[doc]]) + 1, 0, 0))
        if not len(self.hash):
            return [merged(h) for h in hits]
        small = c.astype(np.uint32)
        for runs in self.candidates(c, begins):
            for item, start, doc, edits, x, y in self.verified(small, begins, runs):
                for m in range(len(item)):
                    where = norms[doc[m]][1]
                    a, z = max(0, int(x[m])), min(len(where), int(y[m]))
                    if z > a:
                        hits[doc[m]].append((self.item[item[m]], int(where[a]), int(where[z - 1]) + 1, int(edits[m]), int(start[m])))
        return [merged(h) for h in hits]

    def verified(self, c: np.ndarray, begins: np.ndarray, runs: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
        """(item, start, text, edits, first and last place) of the windows of the runs
        that are within their budget."""
        while len(runs[0]):
            item, low, high, diagonal, doc = runs
            size = self.window[item] - (high - low)   # what all windows of a run have
            ok = np.zeros(len(item), dtype=bool)
            for n in np.unique(size):
                of_size = np.flatnonzero(size == n)
                for part in np.array_split(of_size, len(of_size) // ALIGNED + 1):
                    k = self.budget[item[part]]
                    for budget in np.unique(k):
                        p = part[k == budget]
                        pattern = self.text[(self.begin[item[p]] + high[p])[:, None] + np.arange(n)]
                        body = np.take(c, (begins[doc[p]] + diagonal[p] + high[p])[:, None] + np.arange(n + 2 * budget + 1), mode="clip")
                        edits, x, y = aligned(pattern, body)
                        ok[p] = edits <= budget
                        done = np.flatnonzero((edits <= budget) & (low[p] == high[p]))
                        if len(done):
                            w = p[done]
                            at = diagonal[w] + low[w]
                            yield item[w], low[w], doc[w], edits[done], at + x[done], at + y[done]
            rest = np.flatnonzero(ok & (low < high))
            item, low, high, diagonal, doc = (x[rest] for x in runs)
            middle = (low + high) // 2
            runs = tuple(np.concatenate(x) for x in ((item, item), (low, middle + 1), (middle, high), (diagonal, diagonal), (doc, doc)))

    def unchanged(self, c: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of the short items' places in ``c``."""
        if not self.short:
            return
        letter = (c != 32) & (c != _SEPARATOR)   # neither first nor last: gaps are around all texts
        starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
        for n, (hashes, items) in self.short.items():
            at = starts[letter[starts + n - 1] & ~letter[starts + n]]
            h = _whole(c, at, n)
            for k in np.flatnonzero(np.isin(h, hashes)):
                for item, text in items[int(h[k])]:
                    if (c[at[k]:at[k] + n] == text).all():
                        yield item, int(at[k]), int(at[k]) + n

    def candidates(self, c: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(item, first and last start of a run of windows, first diagonal of a band,
        text) wherever windows share their bound of q-grams with a band, some
        ENTRIES shared q-grams at a time.  ``c`` holds all texts, each from its
        place in ``begins``."""
        h = qgrams(c)
        hit = self.table[_slot(h)]
        hit[:begins[0]] = False
        # A match spans at most segment + budget characters; it must hold the least bound of all windows in marks.
        width, least = SEGMENT + int(self.budget.max()), int(self.bound.min())
        marks = np.concatenate(([0], np.cumsum(hit)))
        n = len(h)
        dense = marks[np.minimum(np.arange(n) + width, n)] - marks[:-1] >= least
        if not dense.any():
            return
        reach = np.zeros(n + 1, dtype=np.int64)
        at = np.flatnonzero(dense)
        np.add.at(reach, at, 1)
        np.add.at(reach, np.minimum(at + width, n), -1)
        at = np.flatnonzero(hit & (np.cumsum(reach[:-1]) > 0))
        first, last = np.searchsorted(self.hash, h[at]), np.searchsorted(self.hash, h[at], side="right")
        upto = np.concatenate(([0], np.cumsum(last - first)))
        # Stretches of the texts, each with the whole of any passage that starts before the next one.
        k = 0
        while k < len(at):
            most = int(np.searchsorted(upto, upto[k] + ENTRIES, side="right")) - 1
            whole = int(np.searchsorted(at, at[k] + 2 * width))   # half of the shortest stretch is new
            end = min(len(at), max(most, whole))
            yield self.runs(at[k:end], first[k:end], last[k:end], begins)
            k = end if end == len(at) else int(np.searchsorted(at, at[end] - width, side="right"))

    def runs(self, at: np.ndarray, first: np.ndarray, last: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
        """Candidates from the q-grams at the places ``at``, whose entries in the
        index are those from ``first`` to before ``last``."""
        none = (np.empty(0, dtype=np.int64),) * 5
        count = last - first
        upto = np.cumsum(count)
        if not upto[-1]:
            return none
        entry = np.arange(upto[-1]) + np.repeat(first - upto + count, count)
        doc = np.searchsorted(begins, at, side="right") - 1   # bands are of one text: the same in any batch
        item, place, at, doc = self.owner[entry], self.place[entry], np.repeat(at - begins[doc], count), np.repeat(doc, count)
        # Bands of 2 (budget + 1) diagonals, each overlapping the next by half: any run of budget + 1, so any
        # alignment within the budget, lies within one.
        half = self.budget[item] + 1
        shift = int(self.length.max() + 2 * (self.budget.max() + 1))
        wide, many = int(at.max()) + shift + 2, len(begins)
        key = (item * many + doc) * wide + (at - place + shift) // half
        keys, group, shared = np.unique(np.concatenate([key, key - 1]), return_inverse=True, return_counts=True)
        e = np.flatnonzero((shared >= self.bound[keys // wide // many])[group])
        group, place = group[e], np.tile(place, 2)[e]
        order = np.lexsort((place, group))
        group, place = group[order], place[order]
        own = np.ones(len(group), dtype=bool)   # a gram of the item counts once
        own[1:] = (group[1:] != group[:-1]) | (place[1:] != place[:-1])
        group, place = group[own], place[own]
        # From each gram to the one that completes the bound: the windows that hold them all.
        item = keys[group] // wide // many
        end = np.arange(len(group)) + self.bound[item] - 1
        i = np.flatnonzero(end < len(group))
        i = i[group[end[i]] == group[i]]
        low = np.maximum(place[end[i]] - (self.window - Q)[item[i]], 0)
        high = np.minimum(place[i], (self.length - self.window)[item[i]])
        ok = low <= high
        i, low, high = i[ok], low[ok], high[ok]
        if not len(i):
            return none
        new = np.ones(len(i), dtype=bool)   # places rise within a band, so do low and high: what touches is one run
        new[1:] = (group[i[1:]] != group[i[:-1]]) | (low[1:] > high[:-1] + 1)
        begin = np.flatnonzero(new)
        i, low, high = i[begin], low[begin], high[np.append(begin[1:], len(i)) - 1]
        count = (high - low) // RUN + 1
        part = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        i, low, high = (np.repeat(x, count) for x in (i, low, high))
        low = low + part * RUN
        high = np.minimum(high, low + RUN - 1)
        return item[i], low, high, keys[group[i]] % wide * (self.budget[item[i]] + 1) - shift, keys[group[i]] // wide % many


def merged(hits: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Overlapping windows (item, start, end, edits, start in the item) of one item
    as one passage; edits: the most of a window that no window about it undercuts."""
    out: list[tuple[int, int, int, list[tuple[int, int]]]] = []
    for item, a, z, e, s in sorted(hits):
        if out and out[-1][0] == item and a <= out[-1][2]:
            out[-1][3].append((s, e))
            out[-1] = (item, out[-1][1], max(z, out[-1][2]), out[-1][3])
        else:
            out.append((item, a, z, [(s, e)]))
    return [(item, a, z, _edits(np.array(w))) for item, a, z, w in out]


def _edits(windows: np.ndarray) -> int:
    """A window that hangs over the end of an excerpt has edits of its own making:
    one within the budget's reach has fewer."""
    order = np.lexsort((windows[:, 1], windows[:, 0]))
    s, e = windows[order].T
    reach = int(SEGMENT * EDIT_RATE)
    first, last = np.searchsorted(s, s - reach), np.searchsorted(s, s + reach, side="right")
    return max(int(x) for x, a, z in zip(e, first, last, strict=True) if x == e[a:z].min())


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark's items, a bounded block at a time."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    b = b.where("item_id is not null and text is not null").distinct()   # repeats give the same passages, and would all hash to one block
    total = b.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = int(total // BLOCK_CHARS) + 1
    for k in range(blocks):
        rows = b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield Index(sorted((r["item_id"], r["text"]) for r in rows))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits): every benchmark passage found."""
    spark = docs.sparkSession
    ready(spark)
    out = None
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)   # bounded by BLOCK_CHARS

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(i, *hit) for i, hits in zip(column_values(batch, "doc_id"),
                                                     shared.value.search(column_values(batch, "text")), strict=True)
                        for hit in hits]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)],
                                                     names=["doc_id", "item_id", "start", "end", "edits"])

        hits = documents(docs).mapInArrow(run, "doc_id long, item_id long, start long, end long, edits long")
        out = hits if out is None else out.unionByName(hits)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark passage, all columns kept."""
    spark = docs.sparkSession
    ready(spark)
    for index in indexes(benchmark):
        docs = docs.where(_untouched(spark.sparkContext.broadcast(index))(F.col("text").cast("string")))
    return docs


def _untouched(shared: Broadcast) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def untouched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([not hits for hits in shared.value.search(texts.tolist())], dtype=bool)

    return untouched
