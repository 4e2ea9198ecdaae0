"""Token ids, packing and Arrow files against the library and exact round trips."""

import os
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from stockflow.llm import arrow_store, packing, tokens
from stockflow.llm.common import fresh_path
from stockflow.llm.tokens import Encoder, default_vocabulary

PARTS = [" ", "  ", "\n", "\n\n", "\t", "a", "don't", "it's", "'s", " '", "é", "世", "1", "22", ".", ",", "...", "!",
         "\x1c", "\x85", "\xa0", "_", "🙂", "Word", "<|endoftext|>", "\r\n", "-", "under stand", "É", "×", "÷", "ß", "²", "½", "ª", "Ω", "\u3000", "\x00",
         "''", "'re", "(x)", "3rd", "\n ", " \n"]


def test_ids_equal_the_library(monkeypatch):
    rng, whole, own = random.Random(1), Tokenizer.from_file(default_vocabulary()), Encoder()
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(14))) for _ in range(12000)] + ["", "x" * 5000, "a b " * 3000]
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == want
    assert [x.tolist() for x in own.encode(texts[::-1])] == want[::-1]   # with everything remembered
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    monkeypatch.setattr(tokens, "SLAB", 2000)
    own, got = Encoder(), []   # generations turn over all the time
    for k in range(0, len(texts), 500):
        got += [x.tolist() for x in own.encode(texts[k:k + 500])]
    assert got == want and own.young.count <= 1000
    assert own.encode([None])[0].tolist() == [] and own.encode([]) == []


@pytest.fixture()
def odd_docs(make_docs):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choices(["alpha", "beta", "gamma!", "x"], k=rng.choice([1, 7, 90, 300, 700, 2500])))) for k in range(60)]
    rows += [(100, None), (101, ""), (None, "no id"), (103, "repeated id"), (103, "repeated id"), (102, "!" * 300)]
    return rows, make_docs(rows, {"start": "1", "length": "2", "shard": "3"})


def ids_of(text):
    whole = Tokenizer.from_file(default_vocabulary())
    return np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def test_packing_covers_every_id_once(odd_docs):
    rows, docs = odd_docs
    pieces = packing.pack(docs.coalesce(2)).collect()
    texts = {k: t for k, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == {r[0] for r in rows}
    for doc, own in by_doc.items():
        if doc != 103:
            ids, at = ids_of(texts[doc]), 0
            for p in sorted(own, key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(ids)
                assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
                at += p["length"]
            assert at == len(ids)
    padded = used = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
        used += at
        padded += 0 if at & (at - 1) == 0 else 1024 - at
    assert padded <= 2 * 1024 and used == sum(p["length"] for p in pieces)   # one padded window a task at most
    loads = {}
    for p in pieces:
        loads[p["step_id"]] = loads.get(p["step_id"], 0) + p["length"]
    assert max(loads.values()) <= packing.STEP_TOKENS + 1024


def test_packing_random_lengths():
    rng = random.Random(3)
    for _ in range(60):
        p, total, rows = packing.Packer(1), 0, []
        for k in range(rng.randrange(1, 60)):
            n = rng.choice([1, 2, 60, 127, 128, 129, 300, 511, 513, 1023, 1024, 1025, 3000])
            total += n
            p.add(k, np.arange(n, dtype="<u4"))
            if rng.random() < 0.1:
                p.pack()
                rows += p.rows()
        p.pack(last=True)
        rows += p.rows()
        assert sum(r[2] for r in rows) == total
        seen = {(r[0], x) for r in rows for x in range(r[1], r[1] + r[2])}
        assert len(seen) == total


def test_a_remainder_waits_without_its_document():
    p = packing.Packer(1)
    for k in range(50):
        p.add(k, np.arange(100 * 1024 + 5, dtype="<u4"))
        p.rows()
    assert sum(h[0][2].nbytes for h in p.held.values()) == 50 * 5 * 4 and all(h[0][2].base is None for h in p.held.values())


def test_orphan_shards_are_swept_and_a_wrong_mask_is_seen(spark, odd_docs, tmp_path):
    folder = fresh_path(spark, "arrow-test")
    manifest = arrow_store.write(odd_docs[1], folder, length=64)
    path = folder.removeprefix("file:")
    open(f"{path}/0000.arrow", "wb").close()
    arrow_store.sweep(manifest, folder)
    assert len(os.listdir(path)) == 2 * manifest.count()
    row = manifest.orderBy("shard").first()
    sequences, _ = arrow_store.open_shard(folder, row["name"])
    with pytest.raises(ValueError, match="mask"):
        arrow_store._Ids(sequences, 64, row["n_tokens"] - 1).crc32(row["n_tokens"] - 2, 1)


def test_arrow_files_round_trip(spark, odd_docs):
    rows, docs = odd_docs
    folder = fresh_path(spark, "arrow-test")
    manifest = arrow_store.write(docs, folder, length=64)
    got = {(r["doc_id"], r["start"]): r for r in arrow_store.read(manifest, folder).collect()}
    assert len(got) == len(rows)
    at = 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(text)
        r = got[doc, at]
        assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids.tobytes())
        at += len(ids)
    # Random access: any sequence, and a mask that marks the padding of the last.
    row = manifest.orderBy("shard").first()
    sequences, _ = arrow_store.open_shard(folder, row["name"])
    n = -(-row["n_tokens"] // 64)
    ids, mask = arrow_store.sequence(sequences, n - 1)
    assert len(ids) == len(mask) == 64 and mask.true_count == (row["n_tokens"] - 1) % 64 + 1


def test_empty_tables(make_docs):
    docs = make_docs([])
    assert packing.pack(docs).count() == 0
    assert arrow_store.encode_to_files(docs).count() == 0
