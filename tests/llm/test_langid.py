"""Long documents, more than 200 languages, and EM against a direct search."""

import math
import random

from pyspark.sql import functions as F

from stockflow.llm import langid


def test_long_documents_teach_like_short_ones(make_docs):
    rows = [(k, "the cat sat on the mat", "en") for k in range(40)] + [(99, "xylo phon " * 4000, "en")]
    rows += [(100 + k, "der hund liegt unter dem tisch und " * 4, "de") for k in range(40)] + [(300, None, "fr")]
    model = langid.fit(make_docs(rows), F.lit(False))
    assert model.languages == ["de", "en"]
    assert model.predict("der hund und der tisch")[0] == "de" and model.predict("the cat on the mat")[0] == "en"
    assert model.predict("xylo phon")[0] == "en"


def test_mixture_equals_a_direct_search():
    import numpy as np

    rng = random.Random(4)
    for _ in range(5):
        p = np.array([[rng.random() for _ in range(2)] for _ in range(30)])
        p /= p.sum(axis=0)
        n = np.array([float(rng.randrange(1, 9)) for _ in range(30)])
        share, fitted = langid.mixture(p, n, steps=400)
        best = max((math.fsum(c * math.log(a * x + b * (1 - x)) for c, (a, b) in zip(n, p, strict=True)), x) for x in (k / 2000 for k in range(1, 2000)))
        assert fitted >= best[0] - 1e-3 and abs(share[0] - best[1]) < 0.02


def test_more_than_200_languages_are_learned(make_docs):
    word = lambda k: "".join(chr(0x4E00 + 3 * k + j) for j in range(3))
    rows = [(k * 10 + j, " ".join([word(k)] * 5), f"l{k:03d}") for k in range(203) for j in range(1 if k == 202 else 2)]
    model = langid.fit(make_docs(rows), F.lit(False))
    assert len(model.languages) == 203 and model.predict(word(202))[0] == "l202"
