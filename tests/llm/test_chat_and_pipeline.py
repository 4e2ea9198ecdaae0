"""Transcript parsing, and the pipeline with its registration."""

import random

import numpy as np
import pytest

from stockflow.llm import catalog, chat

SF0001 = "/root/testdata/sf0.001"


def brute_path(hmm, shown):
    """Best path over the whole sequence in one go."""
    score, back = hmm.start + hmm.show[:, shown[0]], []
    for s in shown[1:]:
        ways = score[:, None] + hmm.step
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + hmm.show[:, s]
    out = [int(score.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return float(score.max()), out[::-1]


def value(hmm, shown, path):
    return (hmm.start[path[0]] + sum(hmm.step[a, b] for a, b in zip(path[:-1], path[1:]))
            + sum(hmm.show[p, s] for p, s in zip(path, shown)))


def test_seams_keep_the_best_path():
    rng = np.random.default_rng(1)
    n = len(chat.STATES)
    for trial in range(20):
        hmm = chat.Hmm(*[np.log(rng.dirichlet(np.ones(k), size=m)).reshape(shape) for k, m, shape in
                         ((n, 1, (n,)), (n, n, (n, n)), (chat.N_SYMBOLS, n, (n, chat.N_SYMBOLS)))])
        shown = rng.integers(0, chat.N_SYMBOLS, size=30)
        cuts = sorted(rng.choice(np.arange(1, 30), size=3, replace=False))
        parts = np.split(shown, cuts)
        fixed = chat.seams([(k, "c", hmm.matrix(p).ravel().tolist()) for k, p in enumerate(parts)], hmm)
        path = [s for k, p in enumerate(parts) for s in hmm.path(p, *fixed[k, "c"])]
        best, _ = brute_path(hmm, shown)
        assert value(hmm, shown, path) == pytest.approx(best)


def test_markers():
    assert chat.marker("User: hello") == ("user", 6) and chat.marker("### Assistant")[0] == "assistant"
    assert chat.marker("[system] be kind")[0] == "system" and chat.marker("<|bot|>")[0] == "assistant"
    assert chat.marker("Bob: hi")[0] == "other" and chat.marker("note: hi")[0] is None
    assert chat.marker("Well then")[0] is None and chat.marker("")[0] is None


def conversations(spark, rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 8)):
            role = "user" if t % 2 == 0 else "assistant"
            lines = [" ".join(rng.choices(["ora", "lente", "sum", "quo"], k=rng.randrange(1, 30))) for _ in range(rng.randrange(1, 5))]
            rows.append((c, t, role, "\n".join(lines) + ("?" if role == "user" else ".")))
    return rows


def test_roles_are_recovered(spark):
    rng = random.Random(2)
    rows = conversations(spark, rng, 120)
    # One conversation holds a third of all lines; odd rows besides.
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"line {t}\nand more\nto say") for t in range(600)]
    odd = [(None, None, None, None), (None, 0, "user", "x"), (501, 0, "bystander", "hm"), (502, 0, "user", ""), (503, 0, "user", None)]
    df = spark.createDataFrame([*rows, *odd], "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "2 as line")
    turns = catalog.transcripts(df)
    hmm = chat.fit(turns)
    lines = turns.selectExpr("conv_id", "turn as major", "posexplode(lines) as (minor, line)")
    got = chat.parse(lines, hmm).collect()
    assert sum(r["n_lines"] for r in got) == lines.count()
    truth = {(c, t): role for c, t, role, _ in rows}
    found = {}
    for r in got:
        assert r["rendered"].startswith(f"<|{r['role']}|>\n")
        found.setdefault((r["conv_id"], r["major"]), []).append(r["role"])
    right = sum(found.get(k) == [role] for k, role in truth.items())
    assert right >= 0.97 * len(truth)
    text = next(r["rendered"] for r in got if (r["conv_id"], r["major"]) == (500, 4))
    assert text == f"<|{found[500, 4][0]}|>\nline 4\nand more\nto say\n"


def test_turns_do_not_depend_on_tasks(spark):
    rng = random.Random(5)
    rows = conversations(spark, rng, 40)
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", "\n" * (t % 3) + f"line {t}\n\nafter a blank line\nto say\n\n") for t in range(60)]
    rows += [(501, 0, "user", "\n".join(["one turn over many tasks", ""] * 400))]
    turns = catalog.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    hmm = chat.fit(turns)
    lines = turns.selectExpr("conv_id", "turn as major", "posexplode(lines) as (minor, line)")
    keys, results = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"], []
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[1], "false")
        for n in (1, 7, 64):
            spark.conf.set(keys[0], str(n))
            results.append(sorted(tuple(r) for r in chat.parse(lines, hmm).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert results[0] == results[1] == results[2] and sum(r[4] for r in results[0]) == lines.count()
    long = [r for r in results[0] if r[0] == 501]
    assert len(long) == 1 and long[0][5].count("one turn") == 400 and not long[0][5].endswith("\n\n")


def test_no_transcripts(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, lines array<string>")
    hmm = chat.fit(empty)
    lines = empty.selectExpr("conv_id", "turn as major", "posexplode(lines) as (minor, line)")
    assert chat.parse(lines, hmm).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as E

    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in E.queries()) == 1 for n in names) and "pipeline" in E.queries()


def test_pipeline_on_small_documents(spark, make_docs, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choices(["th", "er", "on", "an", "re"], k=3)) for _ in range(n))
    items = [(k, prose(40)) for k in range(5)]
    rows, labels = [], []
    for k in range(200):
        text = prose(rng.randrange(30, 120))
        if k % 4 == 0:
            for _ in range(5):
                text = text.replace(" ", " vilewort ", 1) + " grubmuck"
        labels.append((k, 1, int(k % 4 == 0)))
        rows.append((k, text))
    rows += [(1000, rows[1][1]), (1001, rows[2][1].upper()), (1002, prose(60) + " " + items[2][1]), (1003, prose(30) + " reach me at a@b.org")]
    rows += [(1004, None), (1005, ""), (None, prose(50))]
    docs = make_docs(rows, {"start": "3"})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"] for r in now.collect()}
    clean = {k for k, _ in rows if k is None or k >= 1000 or k % 4}
    toxic = {k for k in range(0, 200, 4)}
    assert len(kept["toxicity"] & toxic) <= 2 and clean <= kept["toxicity"]
    assert kept["near-duplicates"] == kept["toxicity"] - {1000, 1001}
    assert kept["decontamination"] == kept["near-duplicates"] - {1002}
    assert kept["personal data"] == kept["decontamination"]
    assert next(r["text"] for r in now.collect() if r["doc_id"] == 1003).endswith("[EMAIL]")
    pieces = P.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in pieces.collect()} == kept["personal data"]
