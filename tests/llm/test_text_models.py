"""Personal data, toxicity, languages and the language model."""

import hashlib
import math
import random
import time
import re
import zlib
from collections import Counter

import pytest

from stockflow.llm import langid, lm, pii, toxicity
from stockflow.llm.words import shingle_sets, word_hashes

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    parts = [*"0123456789" * 2, *"+-. ()@a.bZ%_é", "4111111111111111", "1.2.3.4", "a@b.c", "+1 (555) 555-1234", "256.1.1.1"]
    for _ in range(15000):
        t = "".join(rng.choices(parts, k=rng.randrange(30)))
        assert [f"{k}:{a}:{b}" for k, a, b, _ in pii.spans(t) if k in PATTERNS] == base_spans(t), t


def test_added_kinds_need_evidence():
    kinds = lambda t: [s[0] for s in pii.spans(t)]
    assert kinds("pay to IBAN DE89 3704 0044 0532 0130 00 today") == ["iban"]
    assert kinds("IBAN DE89 3704 0044 0532 0130 01") == []
    assert kinds("social security 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("amex card 378282246310005") == ["card_short"] and kinds("378282246310005") == []
    assert kinds("call 555-123-4567") == ["phone_local"] and kinds("lot 555-123-4567") == []


def test_long_texts_are_scanned_in_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "@" * 100_000, "a@" * 100_000, "1-" * 150_000):
        assert pii.spans(t) is not None


def test_report_and_redaction(make_docs):
    docs = make_docs([(1, "mail bob@x.org, +1 (555) 555-1234 or 10.0.0.1"), (2, None), (3, ""), (4, "é bob@x.org"), (4, "é bob@x.org")],
                     {"spans": "1", "kind": "'k'"})
    rows = pii.report(docs).collect()
    assert all(len([x for x in r["scores"].split(",") if x]) == len([x for x in r["spans"].split(",") if x]) for r in rows)
    one = next(r for r in rows if r["doc_id"] == 1)
    assert (one["n_email"], one["n_ip"], one["n_card"], one["n_phone"]) == (1, 1, 0, 1)
    want = ",".join(base_spans("mail bob@x.org, +1 (555) 555-1234 or 10.0.0.1"))
    assert one["spans"] == want and one["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert [r["base_sha256"] for r in rows if r["doc_id"] in (2, 3)] == [hashlib.sha256(b"").hexdigest()] * 2
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    got = {r["doc_id"]: r for r in clean.collect()}
    assert got[1]["text"] == "mail [EMAIL], [PHONE] or [IP]" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] is None and got[4]["text"] == "é [EMAIL]"
    assert pii.report(make_docs([])).count() == 0


def test_many_spans_take_linear_time():
    def seconds(n):
        text = " ".join(f"call phone 555-{k % 900 + 100}-{k % 9000 + 1000}" for k in range(n))
        at = time.process_time()
        assert len(pii.spans(text)) >= n * 0.9
        return time.process_time() - at
    seconds(100)
    assert seconds(16_000) < 12 * seconds(2_000) + 0.5


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    common = ["".join(rng.choices(["th", "er", "on", "an", "re"], k=rng.randrange(1, 4))) for _ in range(400)]
    bad = ["zotwort", "quibblex", "fuddlemop"]

    def text(toxic):
        words = rng.choices(common, k=rng.randrange(30, 200))
        for _ in range(4 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        return " ".join(words)
    return text


def test_toxicity_on_held_out_documents(spark, make_docs, prose):
    rows = [(k, prose(k % 4 == 0)) for k in range(400)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k, _ in rows] + [(0, 1, 1), (9999, 1, 1), (5, 1, None)],
                                   "doc_id long, quality int, toxic int")
    docs = make_docs([*rows, (1000, None), (1001, ""), (None, "no id"), (1002, "x" * 200_000)], {"score": "1", "toxic": "7"})
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(got) == 404 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(got[k]["held_out"] == (k in held) for k, _ in rows)
    assert sum(got[k]["predicted"] == int(k % 4 == 0) for k in held) >= 0.97 * len(held)
    assert got[1000]["predicted"] == got[1001]["predicted"] == 0 and got[1000]["score"] == got[1001]["score"]
    left = toxicity.reject(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(not r["predicted"] for r in got.values())
    unlabelled = toxicity.score_documents(docs, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in unlabelled} == {0.0}
    assert toxicity.score_documents(make_docs([]), labels).count() == 0


def test_long_labelled_texts_teach(spark, make_docs, prose):
    """Toxic documents above 20,000 characters among short ordinary ones."""
    long = lambda: " ".join(prose(True) for _ in range(40))
    rows = [(k, long() if k % 4 == 0 else prose(False)) for k in range(160)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k, _ in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(make_docs(rows), labels).collect()}
    assert min(len(t) for k, t in rows if k % 4 == 0) > 20_000
    assert sum(got[k]["predicted"] == int(k % 4 == 0) for k, _ in rows if got[k]["held_out"]) >= 0.95 * sum(r["held_out"] for r in got.values())


def test_each_language_has_its_toxic_words():
    rng = random.Random(12)
    stems = {"a": ["ka", "lo", "mi", "tu", "re"], "b": ["stru", "gh", "wen", "olp", "ert"], "c": ["éa", "çou", "eau", "ir", "ment"]}
    bad = {"a": "kalomitu", "b": "ghwenstru", "c": "eauçouir"}   # of ordinary syllables, but more of them

    def text(lang, toxic):
        w = ["".join(rng.choices(stems[lang], k=rng.randrange(1, 3))) for _ in range(rng.randrange(60, 150))]
        for _ in range(5 if toxic else 0):
            w[rng.randrange(len(w))] = bad[lang] + rng.choice(stems[lang])
        return " ".join(w)
    fit = [(lang, toxic, text(lang, toxic)) for lang in "abc" for toxic in [1] * 80 + [0] * 400]
    fit += [("a", 0, fit[90][2])] * 50   # copies are no evidence
    model = toxicity.learn([t for _, c, t in fit if c], [t for _, c, t in fit if not c])
    for lang in "abc":
        found = model.scores([text(lang, 1) for _ in range(50)]) >= toxicity.THRESHOLD
        wrong = model.scores([text(lang, 0) for _ in range(200)]) >= toxicity.THRESHOLD
        assert found.mean() >= 0.9 and wrong.mean() <= 0.02, lang


def test_dictionary_pieces_equal_a_plain_count():
    from collections import Counter

    rng = random.Random(13)
    texts = [[" ".join("".join(rng.choices("abcde", k=rng.randrange(3, 9))) for _ in range(40)) for _ in range(30)] for _ in range(2)]
    texts[0] = [t + " zzyzzyx badbadly" for t in texts[0]]
    toxicity._coded.cache_clear()
    got = set(toxicity.pieces(texts[0], texts[1]).split(b"\0")) - {b""}
    grams = lambda t: Counter(g for k in range(len(t) - 5) if b" " not in (g := t[k:k + 6])[1:-1])
    flat = [[f" {t} ".encode() for t in ts] for ts in texts]
    docs = [Counter(g for t in ts for g in set(grams(t))) for ts in flat]
    rates = [Counter(), Counter()]
    for rate, ts in zip(rates, flat, strict=True):
        for t in ts:
            for g, n in grams(t).items():
                rate[g] += min(toxicity.MOST, n * toxicity.STRETCH / max(len(t) - 5, toxicity.STRETCH // 4))
    marked = set()
    for g, n in docs[0].items():
        m, both = docs[1][g], (n + docs[1][g]) / 60
        if n >= 3 and n / 30 - m / 30 >= 5 * math.sqrt(both * (1 - both) / 15) and (rates[0][g] + 0.5) / 31 >= math.e * (rates[1][g] + 0.5) / 31:
            marked.add(g)
    want = set()
    for t in texts[0]:
        t, k = f" {t} ".encode(), 0
        while k <= len(t) - 6:
            e = k
            while e <= len(t) - 6 and t[e:e + 6] in marked:
                e += 1
            if e > k:
                want.add(t[k:e + 5])
            k = max(e, k + 1)
    assert got == want and any(b"zzyzzyx" in w for w in want)


def test_languages_on_held_out_documents(make_docs):
    rng = random.Random(6)
    stems = {"xx": ["ka", "lo", "mi"], "yy": ["stru", "gh", "wen"], "zz": ["é", "çou", "eau"]}
    text = lambda lang, n: " ".join("".join(rng.choices(stems[lang], k=3)) for _ in range(n))
    rows = [(k, text(lang := "xyz"[k % 3] * 2, rng.randrange(3, 60)), lang) for k in range(300)]
    rows += [(1000, None, "xx"), (1001, "123 !?", "yy"), (1002, text("xx", 60) + " " + text("yy", 30), None), (None, text("zz", 9), None)]
    got = {r["doc_id"]: r for r in langid.identify(make_docs(rows, {"lang_pred": "1", "p": "2"})).collect()}
    held = [r for r in rows[:300] if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sum(got[k]["lang_pred"] == lang for k, _, lang in held) >= 0.97 * len(held)
    assert all(got[r[0]]["held_out"] == (r in held) for r in rows[:300])
    assert got[1000]["lang_pred"] == got[1001]["lang_pred"] == "und" and got[1000]["score"] == 0
    mixed = dict(x.split(":") for x in got[1002]["languages"].split(","))
    assert set(mixed) == {"xx", "yy"} and 0.5 < float(mixed["xx"]) < 0.85
    assert langid.identify(make_docs([])).count() == 0
    assert {r["lang_pred"] for r in langid.identify(make_docs([(1, "abc", None)])).collect()} == {"und"}


def test_word_hashes_follow_the_words():
    rng = random.Random(7)
    texts = ["".join(rng.choices([*"abAB \t\n\x0b\x0c\r\x1c\xa0é", "  "], k=rng.randrange(40))) for _ in range(500)] + ["", None, "a"]
    h, at = word_hashes(texts)
    want = [(t or "").encode().lower().split() for t in texts]
    flat = [w for ws in want for w in ws]
    assert at.tolist() == [0, *__import__("itertools").accumulate(map(len, want))]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))
    sets = shingle_sets(texts, 5)
    for ws, s in zip(want, sets):
        assert len(s) == len({tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))} if ws else ())


def test_language_model(make_docs):
    rng = random.Random(8)
    # A chain: each word has few followers, so contexts help.
    after = {w: rng.sample(range(60), 3) for w in range(60)}

    def text(n):
        w, out = 0, []
        for _ in range(n):
            w = rng.choice(after[w])
            out.append(f"W{w}")
        return " ".join(out)
    rows = [(k, text(rng.randrange(1, 80))) for k in range(400)] + [(1000, None), (1001, ""), (1002, "never seen words"), (None, "W1 w2")]
    got = {r["doc_id"]: r for r in lm.score(make_docs(rows, {"score": "1", "fold": "2", "block": "3"}).repartition(3)).collect()}
    words = {k: [*(t or "").lower().split(), None] for k, t in rows}
    train = Counter(w for k, ws in words.items() if zlib.crc32(("" if k is None else str(k)).encode()) % 5 != 1 for w in ws)
    n, v = sum(train.values()), len(train)
    for k, ws in words.items():
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(train[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"] and r["n_tokens"] > 1]
    assert sum(r["score"] for r in held) > 0.75 * sum(r["base_score"] for r in held)
    assert lm.score(make_docs([])).count() == 0
    assert all(r["base_score"] <= 0 and math.isfinite(r["score"]) for r in lm.score(make_docs([(0, "a b")])).collect())


def test_weights_find_the_mixture():
    import numpy as np
    import pandas as pd

    # Tokens drawn from the bigram estimate in bucket 3, from the unigram one in bucket 1.
    cells = pd.DataFrame({"bucket": [3, 3, 1, 1], "q2": [3, 0, 0, 30], "q1": [30, 20, 8, 40], "n": [900, 100, 900, 1]})
    w = lm.weights(cells, 1e-4)
    assert np.allclose(w.sum(axis=1), 1) and w[3, 0] > 0.8 and w[1, 1] > 0.8 and w[0, 0] == 0
