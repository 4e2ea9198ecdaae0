"""Whitening against a dense singular value decomposition."""

import numpy as np
import pytest

from stockflow.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def check(df):
    got = {}
    for r in whitening.whiten(df).collect():
        got.setdefault((r["vec_id"]), {}).setdefault(r["component"], []).append(r)
    rows = [(r[0], np.floor(256 * np.array(r[1], dtype=float)).astype(np.int64)) for r in df.select("vec_id", "embedding").collect()
            if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    x = np.array(sorted({tuple(v.tolist()) for _, v in rows}))
    n, s = len(x), x.sum(axis=0)
    _, singular, vt = np.linalg.svd(x - s / n, full_matrices=False)
    e, u = singular ** 2 / n, vt.T
    k = min(4, int((e > 1e-15 * e[0]).sum()))
    assert set(got) == {i for i, _ in rows}
    sign = np.zeros(k)
    for i, v in rows:
        assert sorted(got[i]) == list(range(1, k + 1))
        for j in range(k):
            r = got[i][j + 1][0]
            want = (v - s / n) @ u[:, j] / np.sqrt(e[j])
            if not sign[j] and abs(want) > 1e-3:
                sign[j] = np.sign(want * r["whitened"])   # one sign for all rows
            assert r["whitened"] == pytest.approx(want * (sign[j] or 1), abs=1e-9)
            assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s, strict=True))
            assert r["explained"] == pytest.approx(e[j] / e.sum(), rel=1e-9) and r["identity_error"] < 1e-10
    return got


def test_vectors_with_nulls_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    a = np.round(rng.normal(size=(200, 3)) @ rng.normal(size=(3, 6)) * 4) / 4
    rows = [(i, v.tolist()) for i, v in enumerate(a)] + [(500, [1.0] * 6)] * 2 + [(None, [1.0] * 6), (501, [1.0] * 6)]
    rows += [(502, None), (503, [float("nan")] + [0.0] * 5), (504, [None] + [0.0] * 5), (505, [float("inf")] + [0.0] * 5), (506, [])]
    got = check(spark.createDataFrame([r for r in rows if r[0] != 506], SCHEMA).selectExpr("*", "1 as n", "2 as x", "3 as d").repartition(3))
    assert [len(v) for v in got[500].values()] == [2] * 4
    whole = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert whole.where("vec_id = 506").count() == 0 and whole.where("vec_id = 500").count() == 8


def test_fewer_directions_than_entries(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(-3, 4, size=(300, 2)) @ np.array([[1, 2, 3, 0, 1], [0, 1, 1, 1, -1]])
    check(spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(a)], SCHEMA))


def test_ill_conditioned_columns(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(400, 4)) * [1e3, 30, 1, 0.02]
    check(spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(a)], SCHEMA))


def test_lengths_are_fitted_apart_and_degenerate_tables(spark):
    rng = np.random.default_rng(4)
    short, long = [(i, rng.normal(size=2).tolist()) for i in range(50)], [(100 + i, rng.normal(size=3).tolist()) for i in range(50)]
    both = {(r["vec_id"], r["component"]): r["deviation"] for r in whitening.whiten(spark.createDataFrame(short + long, SCHEMA)).collect()}
    for rows in (short, long):
        for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect():
            assert both[r["vec_id"], r["component"]] == r["deviation"]
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, SCHEMA)).count() == 0   # one vector has no direction


def test_whole_numbers_beyond_doubles():
    x = np.array([[2 ** 40, -5], [2 ** 40 + 1, 7], [3, 2 ** 41]], dtype=np.int64)
    n, sums = 3 * 10 ** 7, [int(v) * 10 ** 7 for v in x.sum(axis=0)]
    model = whitening.Whitening(n, sums, np.ones(1), np.ones((2, 1)), 1.0)
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert model.deviation(x) == [w if w < 1 << 63 else None for w in want]
    assert model.deviation(np.array([[1, 1]])) == [None] and whitening.Whitening(2, [3, 1], np.ones(1), np.ones((2, 1)), 1.0).deviation(np.array([[1, 1]])) == [2]
