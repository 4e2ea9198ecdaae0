"""Near-duplicates, benchmark passages and neighbours against brute force."""

import random

import numpy as np
import pytest

from stockflow.llm import ann, decontam, neardup
from stockflow.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return {(k, len(s)): least.get(find(i)) for i, (k, s) in enumerate(sets)}


@pytest.fixture()
def near_docs():
    rng = random.Random(9)
    words = [f"w{k}" for k in range(3000)]
    line = " ".join(rng.choices(words, k=25))   # a passage that very many texts share
    rows, k = [], 0

    def add(t):
        nonlocal k
        rows.append((k, t))
        k += 1
    for _ in range(25):
        base = rng.choices(words, k=rng.randrange(20, 120))
        for _ in range(rng.randrange(1, 6)):   # copies at all similarities
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            add(" ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
    base = rng.choices(words, k=150)
    for _ in range(150):   # one large group of near copies, in a chain of drift
        base[rng.randrange(150)] = rng.choice(words)
        add(" ".join(base))
    for _ in range(150):
        add(line + " " + " ".join(rng.choices(words, k=rng.randrange(5, 60))))
    for t in ("one two three", "one two three", "One  two\tthree", "one two", "a b c d e", "a b c d e f", "", " \n", None, "x " * 30_000):
        add(t)
    rows += [(k, "same text for a repeated id"), (k, "same text for a repeated id"), (None, line), (None, "one two three"), (None, None)]
    return rows


def test_components_of_documents(spark, make_docs, near_docs):
    docs = make_docs(near_docs, {"cls": "1", "n": "2", "tokens": "'x'", "__gone": "1", "__several": "2", "row": "3", "kept": "4"}).repartition(5)
    got = neardup.link(docs).collect()
    want = brute_components(near_docs)
    assert len(got) == len(near_docs)
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"], r["n_shingles"]] and r["kept"] == (r["doc_id"] == r["component_id"]), r
    left = neardup.deduplicate(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    ids = [r["doc_id"] for r in left.collect()]
    heads = {r["doc_id"] for r in got if r["kept"] and r["doc_id"] is not None}
    assert sorted(i for i in ids if i is not None) == sorted(heads) and ids.count(None) == 3


def test_large_nodes_branch_and_meet_in_blocks(make_docs, near_docs, monkeypatch):
    monkeypatch.setattr(neardup, "LIMIT", 12)   # most groups are large now
    monkeypatch.setattr(neardup, "SHINGLES", 300)   # and their sets too long for one block
    want = brute_components(near_docs)
    for r in neardup.link(make_docs(near_docs)).collect():
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"], r["n_shingles"]]


def template_docs(n, alike, seed=4):
    """Texts of one template, each two ``alike`` (Jaccard) without being linked, and a near copy of every tenth."""
    rng = random.Random(seed)
    frame = [f"f{k}" for k in range(120)]
    rows = []
    for k in range(n):
        own = round(120 * (1 - alike) / (2 * alike)) + rng.randrange(0, 3)
        text = frame + [f"u{k}x{j}" for j in range(own)]
        rows.append((len(rows), " ".join(text)))
        if k % 10 == 0:
            text[rng.randrange(20, 100)] = "other"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("alike", [0.5, 0.65, 0.74])
def test_template_texts_do_not_all_meet(make_docs, monkeypatch, alike):
    monkeypatch.setattr(neardup, "LIMIT", 16)
    met = []
    compare = neardup._compare

    def counted(rows, reps, roots):
        if roots:
            met.append(rows.count())
        return compare(rows, reps, roots)

    monkeypatch.setattr(neardup, "_compare", counted)
    for n in (100, 200):
        rows = template_docs(n, alike)
        want = brute_components(rows)
        got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in neardup.link(make_docs(rows)).collect()}
        assert got == want
        assert len(set(want.values())) >= n * 0.9
    assert met[1] <= 2.5 * met[0] + 100, met


def test_no_documents(make_docs):
    assert neardup.link(make_docs([])).count() == 0
    assert neardup.deduplicate(make_docs([])).count() == 0
    assert [r["kept"] for r in neardup.link(make_docs([(5, None)])).collect()] == [True]


def test_components_of_a_chain(spark):
    rows = [(k, k + 1) for k in range(1, 300)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 301)} | {500: 500, 501: 500}


def edit_distance_in(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_banded_alignment_equals_the_full_table():
    rng = random.Random(10)
    codes = lambda s: np.array([ord(c) for c in s], dtype=np.uint64)
    for _ in range(150):
        p, t = ("".join(rng.choices("abc", k=n)) for n in (rng.randrange(1, 12), rng.randrange(0, 25)))
        want, got = edit_distance_in(p, t), decontam.distance(codes(p), codes(t), 4)
        assert (got is None) == (want > 4) and (got is None or got[0] == want), (p, t, got, want)
        if got:
            _, a, z = got
            assert edit_distance_in(p, t[a:z]) == want


def test_benchmark_passages(spark, make_docs):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(40)) for k in range(20)]
    benchmark = spark.createDataFrame([*items, (90, None), (91, ""), (92, "short"), (None, prose(30))], "item_id long, text string")
    rows, truth = [], {}
    for k in range(60):
        item, text = items[k % 20]
        kind = k % 5
        if kind == 1:   # spelling, case and punctuation changed
            chars = list(text)
            for _ in range(len(chars) // 40):
                chars[rng.randrange(len(chars))] = rng.choice("xyz")
            text = "".join(chars).upper().replace(" ", ",\n")
        if kind == 2:   # an excerpt
            a = rng.randrange(len(text) - 130)
            text = text[a:a + 130]
        if kind < 3:
            truth[k] = item
        rows.append((k, f"{prose(rng.randrange(0, 300))} {text if kind < 3 else prose(40)} {prose(rng.randrange(0, 50))}"))
    rows += [(100, None), (101, ""), (102, items[3][1] * 2), (None, items[4][1]), (103, "z" * 200_000), (0, rows[0][1])]
    docs = make_docs(rows, {"item_id": "1", "start": "2"})
    hits = decontam.find(docs, benchmark).collect()
    found = {}
    for h in hits:
        found.setdefault(h["doc_id"], set()).add(h["item_id"])
    assert found == {k: {v} for k, v in truth.items()} | {102: {3}, None: {4}}
    exact = next(h for h in hits if h["doc_id"] == 5)
    assert exact["edits"] == 0 and dict(rows)[5][exact["start"]:exact["end"]].strip() == items[5][1]
    assert sum(h["doc_id"] == 0 for h in hits) == 2
    left = decontam.clean(docs, benchmark)
    assert left.columns == docs.columns and left.count() == len(rows) - len(truth) - 3
    assert decontam.find(make_docs([]), benchmark).count() == 0
    assert decontam.find(docs, benchmark.limit(0)).count() == 0
    assert decontam.clean(docs, benchmark.limit(0)).count() == len(rows)


def test_benchmark_in_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 300)
    items = [(k, " ".join(f"q{k}r{j}s" for j in range(30))) for k in range(8)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([(k, f"before {t} after") for k, t in items] + [(50, "nothing here")])
    assert {(h["doc_id"], h["item_id"]) for h in decontam.find(docs, benchmark).collect()} == {(k, k) for k in range(8)}
    assert [r["doc_id"] for r in decontam.clean(docs, benchmark).collect()] == [50]


def brute_neighbours(vectors, k):
    out = {}
    for q, v in vectors:
        if q is not None and q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for n, (i, w) in enumerate(vectors) if vectors[n][0] != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(1500, 24)).astype("float32")
    base[300:800] = base[300]   # a very common vector
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(base)]
    odd = [(5000, None, 1), (5020, [0.0] * 24, 1), (5040, [float("nan")] * 24, 1), (5060, [float("inf")] * 24, 1),
           (5080, [None] * 24, 1), (5100, [1.0], 1), (None, rows[0][1], 1)]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in ann.search(df, leaf=64, search=1200).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_neighbours([(k, v) for k, v, _ in rows], 20)
    assert set(got) == set(want)
    for q, answer in got.items():
        assert len(answer) == 20 and q not in [i for i, _ in answer]
        assert answer == sorted(answer, key=lambda x: (-x[1], x[0]))
        dots = {i: float(np.dot(np.array(rows[q][1]), np.array(rows[i][1]))) for i, _ in answer}
        assert all(s == pytest.approx(dots[i], abs=1e-12) for i, s in answer)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    assert [i for i, _ in got[320]] == [i for i in range(300, 321) if i != 320]   # ties go to the least ids


def test_blocks_of_queries_lengths_and_copies(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(300)] + [(k, rng.normal(size=3).tolist()) for k in range(300, 340)]
    rows += [(k, rows[0][1]) for k in range(400, 500)]   # one vector very often
    got = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), leaf=64, search=10 ** 6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, v in ((k, np.array(x)) for k, x in rows if k % 20 == 0):
        near = sorted((-float(np.dot(v, x)), k) for k, x in rows if k != q and len(x) == len(v))[:20]
        have = sorted(got[q])
        assert [h[0] for h in have] == list(range(1, len(near) + 1)) and len(near) == 20
        assert [h[2] for h in have] == pytest.approx([-s for s, _ in near])
        if len(v) == 6 and q in (0, 400):
            assert [h[1] for h in have] == [k for k in [0, *range(400, 500)] if k != q][:20]


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    assert ann.search(spark.createDataFrame([], schema)).count() == 0
    assert ann.search(spark.createDataFrame([(20, [1.0, 2.0])], schema)).count() == 0
    rows = ann.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0]), (2, [0.0, 1.0])], schema)).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(rows, key=lambda r: r["rank"])] == [(1, 1, 0.5), (2, 2, 0.0), (3, 2, 0.0)]
