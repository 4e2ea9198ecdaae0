"""Conversation repair against an exhaustive recursion, in one task and by stretches."""

import hashlib
import random
import zlib

import pytest

from stockflow.llm import conversation_repair

NEXT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
SCHEMA = "conv_id long, turn long, role string, text string"


def with_inserts(best):
    again = True
    while again:
        again = False
        for q, (c, a, lines) in list(best.items()):
            for role in ("user", "assistant"):
                to = NEXT.get((q, role[0]))
                if to and (c + 2, a + "I") < best.get(to, (1e9,))[:2]:
                    best[to] = (c + 2, a + "I", (*lines, role + ":"))
                    again = True
    return best


def brute(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = with_inserts({"0": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}

        def put(q, c, a, lines, after=after):
            if q and (q not in after or (c, a) < after[q][:2]):
                after[q] = (c, a, lines)
        for q, (c, a, lines) in best.items():
            put(q, c + 3, a + "D", lines)
            if fault not in ("blank", "duplicate"):
                c += fault == "truncated"
                put(NEXT.get((q, role[:1])), c, a + "K", (*lines, f"{role}:{text}"))
                for new in ("user", "assistant"):
                    put(NEXT.get((q, new[0])), c + 2, a + "R", (*lines, f"{new}:{text}"))
        best = with_inserts(after)
    cost, audit, lines = min(best[q] for q in "0a" if q in best)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [None, "", "  ", "a.", "b", "c!", "d?  \n", "é.", "x" * 50_000 + "."]
    out = [(rng.choice([None, *range(150)]), rng.choice([None, *range(8)]), rng.choice(["user", "user", "assistant", "assistant", "system", "tool", None, ""]),
            rng.choice(texts)) for _ in range(1200)]
    out += [(1000, rng.choice([None, *range(300)]), rng.choice(["user", "assistant", "system", "tool"]),
             rng.choice(["a.", "b", "c!", " ", f"x{rng.randrange(500)}."])) for _ in range(700)]
    return out + [(1001, 5, "user", "hey.")] * 2000


@pytest.mark.parametrize("long, bits", [(4096, 10), (40, 4), (2, 2)])
def test_repair_equals_the_recursion(spark, rows, monkeypatch, long, bits):
    monkeypatch.setattr(conversation_repair, "LONG", long)
    monkeypatch.setattr(conversation_repair, "STRETCH_BITS", bits)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as copies", "'x' as head", "2 as part").repartition(5)
    got = conversation_repair.repair(table).collect()
    want = {k: brute(v) for k, v in damaged(rows).items()}
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r["conv_id"]], r["conv_id"]


def test_nothing_left_and_empty_tables(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    (row,) = conversation_repair.repair(spark.createDataFrame([(gone, 0, "user", "hello.")], SCHEMA)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversation_repair.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_agenda_stops_at_the_goal():
    popped = []

    def deduce(item, chart):
        popped.append(item)
        if item < 100:
            yield item + 1, (chart[item][0] + 1, chart[item][1] + "x")
    chart = conversation_repair.lightest({0: (0, "")}, deduce, {7})
    assert chart[7] == (7, "xxxxxxx") and max(popped) == 7
