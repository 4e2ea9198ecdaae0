"""Words of whole texts as 64-bit hashes, a batch of texts at a time.

A word is a run of bytes other than space and 0x09 to 0x0D, with A-Z lowered.
Its hash is a polynomial in its bytes modulo 2^64, taken from running sums over
the whole batch, then mixed with its length.
"""

from __future__ import annotations

import numpy as np

from stockflow.llm.common import slabs

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 9, 10, 11, 12, 13]] = True
# Powers that a worker keeps; longer ones are made for the batch that needs them.
KEPT = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if len(_powers[0]) >= n:
        return [p[:n] for p in _powers]
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(min(KEPT, 2 * n) if n <= KEPT else n, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if n <= KEPT:
        _powers[:] = out
    return [p[:n] for p in out]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets): the words of text k are offsets[k] to
    offsets[k + 1].  Null counts as empty."""
    blobs = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b" ".join([*blobs, b""]), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    inside = np.concatenate(([False], ~_GAP[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    power, inverse = powers(len(data) + 1)
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=run[1:])
    h = mix((run[end] - run[start]) * inverse[start] + (end - start).astype(np.uint64) * _M2)
    begins = np.concatenate(([0], np.cumsum([len(b) + 1 for b in blobs])))
    return h, np.searchsorted(start, begins).astype(np.int64)


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted: ``size`` words each, or all
    words as one if there are fewer; empty without words."""
    return [s for part in slabs(texts, KEPT // 2) for s in _shingle_sets(part, size)]


def _shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    h, at = word_hashes(texts)
    n = len(h) - size + 1
    if n > 0:
        s = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            s = s * _BASE + h[k:k + n]
        s = mix(s)
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(s[a:b - size + 1]))
        elif b > a:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = np.uint64((int(one) * int(_BASE) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([one], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
