"""Benchmark excerpts at every offset against the rule itself."""

import random

import numpy as np

from stockflow.llm import decontam


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(n))


def codes(text):
    return decontam.normal(text)[0]


def brute(item, text):
    """Least edits of any window of the item in the text, by the full table."""
    c, t = codes(item), codes(text)
    c = c[:-1] if len(c) and c[-1] == 32 else c
    size, least = min(len(c), decontam.SEGMENT), None
    for s in range(len(c) - size + 1):
        found = decontam.distance(c[s:s + size], t, int(size * decontam.EDIT_RATE))
        least = found[0] if found and (least is None or found[0] < least) else least
    return least


def test_excerpts_of_80_characters_at_every_offset():
    rng = random.Random(21)
    items = [(7, prose(rng, 60)), (8, prose(rng, 60))]
    index = decontam.Index(items)
    item = items[0][1]
    inside = [k for k in range(len(item) - 79) if " " not in (item[k], item[k + 79])]
    texts = [f"{prose(rng, 9)} {item[k:k + 80]} {prose(rng, 9)}" for k in inside]
    for k, text, hits in zip(inside, texts, index.search(texts), strict=True):
        assert len(hits) == 1 and hits[0][0] == 7 and hits[0][3] == 0, (k, hits)
        a = text.index(item[k:k + 80])
        assert hits[0][1] <= a and a + 80 <= hits[0][2] and hits[0][2] - hits[0][1] <= 80 + 2 * 12, (k, hits)


def test_edited_excerpts_equal_the_rule():
    rng = random.Random(22)
    items = [(k, prose(rng, rng.choice((5, 6, 9, 14, 30, 45)))) for k in range(12)]
    index = decontam.Index(items)
    texts, sources = [], []
    for _ in range(90):
        k = rng.randrange(len(items))
        part = list(items[k][1])
        a = rng.randrange(max(1, len(part) - 80))
        part = part[a:a + rng.randrange(76, 110)]
        for _ in range(rng.randrange(10)):
            p = rng.randrange(len(part))
            part[p:p + 1] = rng.choice(([], ["z"], [part[p], "y"]))
        texts.append(f"{prose(rng, rng.randrange(6))} {''.join(part)} {prose(rng, rng.randrange(6))}".strip())
        sources.append(k)
    hits = index.search(texts)
    want = [brute(items[k][1], t) for k, t in zip(sources, texts, strict=True)]
    assert 20 < sum(w is None for w in want) < 70
    for k, w, found in zip(sources, want, hits, strict=True):
        assert {h[0] for h in found} == (set() if w is None else {k})
        assert w is None or min(h[3] for h in found) >= w
    assert index.search(texts[::-1]) == hits[::-1]


def test_long_items_and_short_texts_in_one_batch():
    rng = random.Random(23)
    item = prose(rng, 2000)
    index = decontam.Index([(1, item), (2, None), (3, "")])
    words = item.split()
    texts = [" ".join(words[k:k + 20]) for k in range(0, 1980, 20)] + [None, "", prose(rng, 300), item]
    got = index.search(texts)
    assert [bool(h) for h in got] == [len(codes(t)) >= 80 for t in texts[:-4]] + [False, False, False, True]
    assert got[-1] == [(1, 0, len(item), 0)]


def test_alignment_on_a_band_prefers_the_shortest_place():
    p, t = np.array([[1, 2, 3, 4]]), np.array([[9, 9, 2, 3, 4, 9, 9]])
    assert [int(x[0]) for x in decontam.aligned(p, t)] == [1, 2, 5]


def test_short_items_match_unchanged_words():
    index = decontam.Index([(1, "Who wrote it?"), (2, "x"), (3, "ça va"), (4, "?!"), (5, "Who wrote it"), (6, "twenty-three characters")])
    texts = ["So: who  WROTE it, then", "who wrote its", "awho wrote it", "X", "x1 xx", "Ça-va?", "?!", None, "who wrote", "x, x",
             "they have twenty three characters.", "twenty three character"]
    got = index.search(texts)
    assert [{h[0] for h in hits} for hits in got] == [{1, 5}, set(), set(), {2}, set(), {3}, set(), set(), set(), {2}, {6}, set()]
    assert [texts[0][h[1]:h[2]] for h in got[0]] == ["who  WROTE it"] * 2 and len(got[9]) == 2
    assert all(h[3] == 0 for hits in got for h in hits)
    rng = random.Random(24)
    item = prose(rng, 40)
    both = decontam.Index([(1, "who wrote it"), (9, item)]).search([f"{item} who wrote it", item, "who wrote it"])
    assert [{h[0] for h in hits} for hits in both] == [{1, 9}, {9}, {1}]


def test_repeats_of_a_row_do_not_fill_a_block(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 2000)
    item = prose(random.Random(25), 20)
    benchmark = spark.createDataFrame([(1, item)] * 60 + [(2, item)], "item_id long, text string")
    assert [sorted(i.item) for i in decontam.indexes(benchmark)] == [[1, 2]]
    assert sorted(r["item_id"] for r in decontam.find(make_docs([(5, item)]), benchmark).collect()) == [1, 2]


def test_items_with_one_opening_phrase(monkeypatch):
    rng = random.Random(26)
    phrase = prose(rng, 30)[:55].strip() + "q"
    items = [(k, f"{phrase} {prose(rng, 25)}") for k in range(15)]
    texts = [" ".join(f"{phrase} {prose(rng, 9)}" for _ in range(5)), f"{phrase} {items[3][1][57:90]} {prose(rng, 9)} {items[7][1]}",
             f"{phrase} {items[5][1][57:95].replace('a', 'zz')}"]
    want = [{k for k, item in items if brute(item, t) is not None} for t in texts]
    assert {3, 7} <= want[1]
    aligned, rows = decontam.aligned, []
    monkeypatch.setattr(decontam, "aligned", lambda p, t: (rows.append(len(p)), aligned(p, t))[1])
    assert decontam.Index(items).search(texts[:1]) == [[]] and want[0] == set()
    assert len(items) <= sum(rows) <= 4 * len(items) * 5   # five places; not each of some 25 windows in two bands
    whole = decontam.Index(items).search(texts)
    assert [{h[0] for h in hits} for hits in whole] == want
    for entries in (1, 300, 5000):   # stretches of any size give the same passages
        monkeypatch.setattr(decontam, "ENTRIES", entries)
        assert decontam.Index(items).search(texts) == whole


def test_stretches_of_marks_far_apart(monkeypatch):
    rng = random.Random(27)
    item = prose(rng, 300)
    index = decontam.Index([(1, item), (2, "ab" * 2000)])
    texts = [f"{item[:120]} {prose(rng, 100)} {item[400:700]}", "ab" * 300, f"{'ba' * 60} {item}", prose(rng, 50)]
    whole = index.search(texts)
    assert [{h[0] for h in hits} for hits in whole] == [{1}, {2}, {1, 2}, set()]
    monkeypatch.setattr(decontam, "ENTRIES", 1)
    assert index.search(texts) == whole
