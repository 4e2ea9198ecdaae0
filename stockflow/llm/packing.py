"""Hierarchical packing of token ids into several window sizes (operator 4).

A document's ids (with the end id) are cut into full windows of the largest
tier; what remains is routed to the smallest tier that holds it.  Then, tier by
tier from the longest: a remainder opens a window, the gap it leaves is filled
with the longest shorter remainders that fit, and the last gap with the head of
a shorter one, whose tail goes on in its own tier.  Short tiers then fill
windows of their own size in the same way.  All tiers are powers of two, so a
window is either exactly full or it is the one padded window of its task.
Windows of a task are dealt to step groups of equal token counts (longest
first, always to the lightest group), which mixes the tiers.

Everything happens where the documents lie: no shuffle, and each task keeps at
most POOL_TOKENS ids besides one batch.  Null or empty text: the end id alone.
Null and repeated doc_ids: each row is a document.  Empty table: no rows.
Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stockflow.llm.common import column_values, documents, ready
from stockflow.llm.tokens import encoder

TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 8 * 1024
POOL_TOKENS = 1 << 21
END_ID = 0

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_id long")


class Packer:
    """Packs one task's documents.  ``rows`` are finished pieces."""

    def __init__(self, task: int, tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = sorted(tiers), step_tokens
        self.base, self.sequences, self.steps = task << 32, 0, 0
        self.pools: dict[int, list[tuple[int, int]]] = {t: [] for t in self.tiers}  # tier -> sorted (length, piece key)
        self.held: dict[int, tuple] = {}   # piece key -> ((doc_id, its ids, those held, place of the first held), first id, number of ids)
        self.closed: list[tuple[int, list[tuple]]] = []   # (tier, pieces) without a step yet
        self.next_key = 0
        self.pooled = dict.fromkeys(self.tiers, 0)   # ids waiting in each tier

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        top, n = self.tiers[-1], len(ids)
        whole = n - n % top
        for s in range(0, whole, top):
            self.closed.append((top, [((doc_id, n, ids, 0), s, top)]))
        if whole < n:   # a remainder waits without the rest of its document
            self._route((doc_id, n, ids[whole:].copy(), whole), whole, n - whole)

    def _route(self, doc: tuple, start: int, length: int) -> None:
        tier = next(t for t in self.tiers if t >= length)
        self.held[self.next_key] = (doc, start, length)
        insort(self.pools[tier], (length, self.next_key))
        self.next_key += 1
        self.pooled[tier] += length

    def _take(self, tier: int, at: int = -1) -> tuple:
        length, key = self.pools[tier].pop(at)
        self.pooled[tier] -= length
        return self.held.pop(key)

    def _fill(self, pieces: list[tuple], gap: int, below: list[int]) -> int:
        """Fill a gap from the tiers ``below`` (longest first); what is left of it."""
        for t in below:
            pool = self.pools[t]
            while pool and (at := bisect_right(pool, (gap, self.next_key))):
                pieces.append(self._take(t, at - 1))
                gap -= pieces[-1][2]
                if not gap:
                    return 0
        for t in reversed(below):   # every remainder left is longer than the gap: cut one
            if self.pools[t]:
                doc, start, length = self._take(t)
                pieces.append((doc, start, gap))
                self._route(doc, start + gap, length - gap)
                return 0
        return gap

    def pack(self, last: bool = False) -> None:
        """Close every window that can be filled; at the end of the task also
        the one that cannot."""
        for k in range(len(self.tiers) - 1, -1, -1):
            tier, reach = self.tiers[k], self.tiers[k::-1]
            while self.pools[tier] and sum(self.pooled[t] for t in reach) >= tier:
                pieces = [self._take(tier)]
                if self._fill(pieces, tier - pieces[0][2], reach):
                    raise AssertionError("enough ids were pooled to fill the window")
                self.closed.append((tier, pieces))
        if last:
            rest = [self._take(t) for t in reversed(self.tiers) for _ in range(len(self.pools[t]))]
            if rest:
                self.closed.append((self.tiers[-1], rest))

    def rows(self) -> list[tuple]:
        """Rows of the windows closed so far, dealt to balanced step groups."""
        windows = sorted(self.closed, key=lambda w: -sum(p[2] for p in w[1]))
        total = sum(p[2] for _, w in windows for p in w)
        groups = [(0, k) for k in range(-(-total // self.step_tokens))]
        out = []
        for tier, pieces in windows:
            load, step = heapq.heappop(groups)
            offset = 0
            for (doc_id, n, ids, place), start, length in pieces:
                crc = zlib.crc32(ids[start - place:start - place + length])
                out.append((doc_id, start, length, crc, n, self.base + self.sequences, offset, tier,
                            self.base + self.steps + step))
                offset += length
            heapq.heappush(groups, (load + offset, step))
            self.sequences += 1
        self.steps += len(groups)
        self.closed = []
        return out


def pack(docs: DataFrame, vocabulary: str | None = None, tiers: Sequence[int] = TIERS,
         step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: which ids of which document lie where in which
    sequence.  Tiers must be powers of two."""
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    ready(docs.sparkSession)
    names = [c.split()[0] for c in PIECES.split(", ")]
    types = [pa.int32() if c.endswith(" int") else pa.int64() for c in PIECES.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, packer, end = encoder(vocabulary), Packer(TaskContext.get().partitionId(), tiers, step_tokens), [END_ID]
        for batch in batches:
            texts = column_values(batch, "text")
            for doc_id, ids in zip(column_values(batch, "doc_id"), tool.encode(texts), strict=True):
                packer.add(doc_id, np.concatenate((ids, np.array(end, dtype="<u4"))))
            if sum(packer.pooled.values()) >= POOL_TOKENS:
                packer.pack()
            if rows := packer.rows():
                yield batch_of(rows)
        packer.pack(last=True)
        if rows := packer.rows():
            yield batch_of(rows)

    return documents(docs).mapInArrow(run, PIECES)
