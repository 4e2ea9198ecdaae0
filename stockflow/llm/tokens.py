"""Token ids of whole texts with a vocabulary file of the tokenizers library.

A byte-level BPE cuts a text with a fixed pattern before it merges bytes; the
pattern looks ahead but never back.  ``cuts`` finds places where it always cuts:

* before white space that follows something else;
* in a run of white space that is followed by something, before its last
  character, and after that unless it is a space (a space opens the next piece);
* between letters, digits and other marks of ASCII (and Latin-1 letters), but not
  after an apostrophe, which may take letters with it.

So the ids of a text are the ids of its pieces, one after another.  Pieces recur:
each worker keeps the ids of those it has met, found by a 64-bit hash of the
piece for a whole batch at once, and the library encodes the rest.  What is kept
has two generations of REMEMBERED pieces; when the younger is full it becomes the
older, and only pieces met again come back.  Texts with characters for which
the rules above do not hold (other white space, control characters, the
vocabulary's special tokens) and files of any other kind go to the library whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from stockflow.llm.words import _INVERSE, _M2, mix, powers

# Pieces of one generation, about 60 bytes each; bytes of text that are cut at a time.
REMEMBERED = 300_000
SLAB = 1 << 20

_SEPARATOR, _WHITE, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _OTHER = range(7)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _WHITE
_CLASS[33:127] = _MARK
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[39] = _APOSTROPHE
_CLASS[255] = _SEPARATOR   # no byte of UTF-8
# Pairs of classes that the pattern always parts.
_PARTED = np.zeros((7, 7), dtype=bool)
for _a, _bs in {_LETTER: (_DIGIT, _MARK, _APOSTROPHE), _DIGIT: (_LETTER, _MARK, _APOSTROPHE), _MARK: (_LETTER, _DIGIT)}.items():
    _PARTED[_a, _bs] = True
_PARTED[2:, _WHITE] = True
_PARTED[_SEPARATOR, :] = _PARTED[:, _SEPARATOR] = True
_PARTED = _PARTED.ravel()
# Other white space of Unicode, as UTF-8: fixed values.
_WIDE_SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_CONTROLS = bytes(c for c in range(32) if c not in (9, 10, 11, 12, 13)) + b"\x7f"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cuts(data: np.ndarray) -> np.ndarray:
    """Starts of the pieces of ``data``: texts, each with a separator byte (255) after it."""
    kind = _CLASS[data]
    lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))   # Latin-1 letters; not the two signs among them
    kind[lead] = kind[lead + 1] = _LETTER
    parted = _PARTED[kind[:-1] * np.uint8(7) + kind[1:]]
    last = np.flatnonzero((kind[:-1] == _WHITE) & (kind[1:] > _WHITE))   # the last white character before something
    parted[last[data[last] != 32]] = True
    parted[last[last > 0] - 1] = True
    return np.concatenate(([0], np.flatnonzero(parted) + 1))


class Pieces:
    """Ids of pieces by hash: an open table of one generation."""

    def __init__(self) -> None:
        self.mask = (1 << 16) - 1
        self.keys = np.zeros(self.mask + 1, dtype=np.uint64)
        self.place = np.zeros(self.mask + 1, dtype=np.int32)
        self.count, self.used = 0, 0
        self.begin = np.zeros(1 << 15, dtype=np.int64)
        self.length = np.zeros(1 << 15, dtype=np.int32)
        self.ids = np.zeros(1 << 17, dtype="<u4")

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 if unknown."""
        out = np.full(len(h), -1, dtype=np.int32)
        slot = (h & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            key = self.keys[slot]
            hit = key == h[left]
            out[left[hit]] = self.place[slot[hit]]
            on = ~hit & (key != 0)
            left, slot = left[on], (slot[on] + 1) & self.mask
        return out

    def _insert(self, h: np.ndarray, number: np.ndarray) -> None:
        slot = (h & np.uint64(self.mask)).astype(np.int64)
        while len(h):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.place[slot[won]] = h[won], number[won]
            lost = np.ones(len(h), dtype=bool)
            lost[won] = False
            h, number, slot = h[lost], number[lost], (slot[lost] + 1) & self.mask

    def add(self, h: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """New pieces with distinct hashes and their ids, one after another."""
        n = self.count + len(h)
        if 2 * n > self.mask:
            old, at = self.keys, self.place
            self.mask = (1 << (3 * n).bit_length()) - 1
            self.keys, self.place = np.zeros(self.mask + 1, dtype=np.uint64), np.zeros(self.mask + 1, dtype=np.int32)
            self._insert(old[old != 0], at[old != 0])
        for name, wanted in (("begin", n), ("length", n), ("ids", self.used + len(ids))):
            array = getattr(self, name)
            if wanted > len(array):
                setattr(self, name, np.concatenate((array, np.zeros(max(wanted, 2 * len(array)) - len(array), dtype=array.dtype))))
        self.begin[self.count:n] = self.used + np.cumsum(sizes) - sizes
        self.length[self.count:n] = sizes
        self.ids[self.used:self.used + len(ids)] = ids
        self._insert(h, np.arange(self.count, n, dtype=np.int32))
        self.count, self.used = n, self.used + len(ids)

    def gather(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of pieces, one after another."""
        size = self.length[number].astype(np.int64)
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        return size, self.ids[np.repeat(self.begin[number] - upto + size, size) + np.arange(total)]


class Encoder:
    """``encode(texts)`` gives one uint32 array per text (null: empty)."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_vocabulary())
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.vocabulary_size = max(names.values(), default=0) + 1
        self.opens = np.zeros(self.vocabulary_size, dtype=bool)   # ids whose first byte is a space
        self.opens[[i for name, i in names.items() if name.startswith("Ġ")]] = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        cutter = self.tokenizer.pre_tokenizer
        self.by_piece = (self.tokenizer.normalizer is None and type(cutter).__name__ == "ByteLevel"
                         and not getattr(cutter, "add_prefix_space", True) and getattr(cutter, "use_regex", False)
                         and not any(t.lstrip or t.rstrip or t.single_word for t in added))
        self.odd = [*_WIDE_SPACES, *(t.content.encode() for t in added)]
        self.young, self.old = Pieces(), Pieces()

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of pieces.  Letters after a space are encoded in one run, in
        which every piece opens with an id whose first byte is the space."""
        spaced = [k for k, p in enumerate(pieces) if p[0] == " " and p[1:].isalpha()]
        rest = sorted(set(range(len(pieces))).difference(spaced))
        found: list[np.ndarray] = [None] * len(pieces)   # type: ignore[list-item]
        for at in range(0, len(spaced), 20_000):
            part = spaced[at:at + 20_000]
            ids = self._library(["".join([pieces[k] for k in part])])[0]
            for k, own in zip(part, np.split(ids, np.flatnonzero(self.opens[ids])[1:]), strict=True):
                found[k] = own
        for k, own in zip(rest, self._library([pieces[k] for k in rest]), strict=True):
            found[k] = own
        return np.fromiter(map(len, found), dtype=np.int64, count=len(found)), np.concatenate(found)

    def _learn(self, h: np.ndarray, start: np.ndarray, end: np.ndarray, blob: bytes) -> None:
        """Put pieces that the young generation lacks into it."""
        h, first = np.unique(h, return_index=True)
        if self.young.count + len(h) > REMEMBERED and self.young.count:
            self.old, self.young = self.young, Pieces()
        known = self.old.find(h)
        back = known >= 0
        if back.any():
            self.young.add(h[back], *self.old.gather(known[back]))
        if not back.all():
            new = first[~back]
            pieces = [blob[a:z].decode() for a, z in zip(start[new].tolist(), end[new].tolist(), strict=True)]
            self.young.add(h[~back], *self._encode_pieces(pieces))

    def _slab(self, blobs: list[bytes]) -> list[np.ndarray]:
        blob = b"\xff".join([*blobs, b""])
        data = np.frombuffer(blob, dtype=np.uint8)
        start = cuts(data)
        end = np.append(start[1:], len(data))
        inside = data[start] != 255
        start, end = start[inside], end[inside]
        power, inverse = powers(len(data) + 1)
        run = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=run[1:])
        h = mix((run[end] - run[start]) * inverse[start] + (end - start).astype(np.uint64) * _M2) | np.uint64(1)
        del run
        number = self.young.find(h)
        if (number < 0).any():
            missing = np.flatnonzero(number < 0)
            generation = self.young
            self._learn(h[missing], start[missing], end[missing], blob)
            if self.young is generation:
                number[missing] = self.young.find(h[missing])
            else:   # a new generation: all pieces of this slab belong to it
                missing = np.flatnonzero(self.young.find(h) < 0)
                if len(missing):
                    self._learn(h[missing], start[missing], end[missing], blob)
                number = self.young.find(h)
        size, ids = self.young.gather(number)
        upto = np.concatenate(([0], np.cumsum(size)))
        begins = np.cumsum([0, *(len(b) + 1 for b in blobs)])
        return np.split(ids, upto[np.searchsorted(start, begins[1:-1])])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        texts = [t or "" for t in texts]
        if not self.by_piece:
            return self._library(texts)
        blobs = [t.encode("utf-8", "surrogatepass") for t in texts]
        whole = b"\xff".join(blobs)
        kinds = [o for o in self.odd if o in whole]
        controls = len(whole.translate(None, _CONTROLS)) != len(whole)
        del whole
        plain, odd = list(range(len(texts))), []
        if kinds or controls:
            odd = [k for k, b in enumerate(blobs) if any(o in b for o in kinds) or len(b.translate(None, _CONTROLS)) != len(b)]
            plain = sorted(set(plain).difference(odd))
        out: list[np.ndarray] = [None] * len(texts)   # type: ignore[list-item]
        for k, ids in zip(odd, self._library([texts[k] for k in odd]) if odd else [], strict=True):
            out[k] = ids
        at = 0
        while at < len(plain):
            held, part = 0, []
            while at < len(plain) and (not part or held + len(blobs[plain[at]]) <= SLAB):
                part.append(plain[at])
                held += len(blobs[plain[at]])
                at += 1
            for k, ids in zip(part, self._slab([blobs[k] for k in part]), strict=True):
                out[k] = ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)
