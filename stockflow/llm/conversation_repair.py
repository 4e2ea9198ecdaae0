"""Cheapest repair of damaged conversations by Knuth's lightest derivation (operator 12).

A repaired conversation's role initials match ``(s?(ua)+)?``.  Edits: K keeps a
row (0), R gives it role user or assistant (2), D deletes it (3; a must for
blank rows and duplicates), I inserts an empty user or assistant row (2); a row
that ends without ``.!?`` costs 1 more unless it is deleted.

Items say what part of a conversation is repaired and the state of the pattern
before and after: ``(i, q)`` for its first i rows, and an axiom for each edit of
a row.  A deduction joins a prefix and an edit.  Its value is (sum of costs,
concatenated initials), which is never below an antecedent's and keeps their
order, so the agenda pops items in their final order and can stop when the goal
is popped: the cheapest edits, of equal ones those least in ASCII order.  The
state follows from the edits (an inserted or renamed row can have one role
only), so the edits alone give the repaired text.

Equal rows of a turn are counted before they are shuffled.  A conversation of up
to LONG rows is repaired in one task.  A longer one is cut into stretches of
STRETCH rows that separate tasks repair from every state to every state; these
spans are deduced into one another in order, holding only what tells the four
states' edits apart; then the stretches' texts are written in parallel, and one
task streams them through SHA-256, which has no parallel form.

Rows of one turn are taken by role, then text (as bytes).  Null role or text:
one space, as in the damage key.  Null turn: first, and not counted in gaps.
Null conv_id: a conversation of its own.  Repeated rows: duplicates.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import ready, stored

WHITE = " \t\n\x0b\x0c\r"
MARKS = ".!?"
LONG, LONG_CHARS, STRETCH_BITS = 4096, 1 << 24, 10
FAULTY = {"blank": 2, "duplicate": 2, "truncated": 1}

Value = tuple[int, str]
# A row for the agenda: (role initial, 0 sound / 1 truncated / 2 to be deleted, number of equal rows it stands for).
Row = tuple[str, int, int]
_NEXT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
_ROLES = {"u": "user", "a": "assistant"}
_RESULT = "conv_id long, illegal long, cost long, audit string, repaired_sha256 string"


def lightest(axioms: dict, deduce: Callable[[object, dict], Iterable[tuple[object, Value]]], goals: set) -> dict:
    """Items with their least values, up to where all ``goals`` are final.

    ``deduce(item, chart)`` gives the conclusions that have ``item``, final just
    now, as one antecedent and others from ``chart``."""
    chart: dict = {}
    agenda: list[tuple[Value, str, object]] = []
    for item, value in axioms.items():
        heappush(agenda, (value, repr(item), item))
    left = set(goals)
    while agenda and left:
        value, _, item = heappop(agenda)
        if item in chart:
            continue
        chart[item] = value
        left.discard(item)
        for conclusion, found in deduce(item, chart):
            if conclusion not in chart:
                heappush(agenda, (found, repr(conclusion), conclusion))
    return chart


def _edits(rows: list[Row]) -> dict:
    """Axioms: the edits ("edit", row, initial) of every row."""
    axioms = {}
    for i, (_, kind, copies) in enumerate(rows):
        axioms["edit", i, "D"] = (3 * copies, "D" * copies)
        if kind < 2:
            axioms["edit", i, "K"] = (kind, "K")
            axioms["edit", i, "R"] = (2 + kind, "R")
    return axioms


def derive(rows: list[Row], start: str = "0", goals: Iterable[str] | None = None) -> dict[str, Value]:
    """Least value of repairing all ``rows`` from state ``start``, by the state
    at the end (of ``goals`` only the first final one, if these are given)."""
    n = len(rows)
    done = {("end",)} if goals is not None else {(n, q) for q in "0sua" if q != "0" or start == "0"}

    def joined(prefix: tuple, edit: tuple, chart: dict) -> Iterator[tuple[object, Value]]:
        i, q = prefix
        c, a = chart[prefix]
        d, b = chart[edit]
        to = q if edit[2] == "D" else _NEXT.get((q, rows[i][0])) if edit[2] == "K" else "a" if q == "u" else "u"
        if to is not None:
            yield (i + 1, to), (c + d, a + b)

    def deduce(item: tuple, chart: dict) -> Iterator[tuple[object, Value]]:
        if item[0] == "edit":
            for q in "0sua":
                if (item[1], q) in chart:
                    yield from joined((item[1], q), item, chart)
        elif item != ("end",):
            i, q = item
            c, a = chart[item]
            for e in "DKR":
                if ("edit", i, e) in chart:
                    yield from joined(item, ("edit", i, e), chart)
            yield (i, "a" if q == "u" else "u"), (c + 2, a + "I")
            if i == n and goals is not None and q in goals:
                yield ("end",), (c, a)

    chart = lightest({(0, start): (0, ""), **_edits(rows)}, deduce, done)
    if goals is not None:
        return {"end": chart["end",]}
    return {q: chart[n, q] for q in "0sua" if (n, q) in chart}


def apply_edits(audit: str, rows: Iterable[tuple[str, str, int]], state: str = "0") -> Iterator[str]:
    """The repaired ``role:text`` lines; ``rows`` are (role, text, copies)."""
    letters = iter(audit)
    for role, text, copies in rows:
        while copies:
            e = next(letters)
            if e == "I":
                state = "a" if state == "u" else "u"
                yield f"{_ROLES[state]}:"
                continue
            copies -= 1
            if e == "K":
                state = _NEXT[state, role[:1]]
                yield f"{role}:{text}"
            elif e == "R":
                state = "a" if state == "u" else "u"
                yield f"{_ROLES[state]}:{text}"
    for _ in letters:   # what is inserted after the last row
        state = "a" if state == "u" else "u"
        yield f"{_ROLES[state]}:"


def illegal_pairs(initials: Iterable[tuple[str, int]]) -> int:
    """Adjacent initials other than su, ua and au; equal rows follow one another."""
    count, before = 0, None
    for c, copies in initials:
        count += (before is not None and before + c not in ("su", "ua", "au")) + copies - 1
        before = c
    return count


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the fault that crc32 of ``conv_id:turn`` picks, put into each row."""
    space = F.lit(" ")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("kind", F.crc32(key.cast("binary")) % 20).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", MARKS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), times)).alias("__one")).drop("__one")


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, copies) with ``head``, the first
    fault of the first copy (or null), and ``rest``, that of the others."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("at", F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn")))
    first = (rows.groupBy("conv_id", "role", "text").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
             .select(F.col("conv_id").alias("c_"), F.col("role").alias("r_"), F.col("text").alias("t_"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("role") == F.col("r_")) & (F.col("text") == F.col("t_"))
    rows = rows.join(first, same, "left")
    body = F.rtrim("text", F.lit(WHITE))
    blank, seen = body == "", F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    cut = ~F.right(body, F.lit(1)).isin(*MARKS)
    head = F.when(blank, "blank").when(seen, "duplicate").when(cut, "truncated")
    rest = F.when(blank, "blank").otherwise("duplicate")
    return rows.select("conv_id", "turn", "role", "text", "copies", head.alias("head"), rest.alias("rest"))


def _agenda_rows(role: str, head: str | None, copies: int) -> list[Row]:
    kind = FAULTY.get(head, 0)
    if kind == 2:
        return [(role[:1], 2, copies)]
    return [(role[:1], kind, 1), *([(role[:1], 2, copies - 1)] if copies > 1 else [])]


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(key, rows) of sorted batches; the rows are a list, so a group must be small."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key and held:
                yield key, held
                held = []
            key = row[:keys]
            held.append(row[keys:])
    if held:
        yield key, held


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


_ORDER = ["turn", "role", "text"]   # ascending: nulls come first


def repair_short(rows: DataFrame) -> DataFrame:
    """Conversations that a task holds: repaired one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        names, types = ["conv_id", "illegal", "cost", "audit", "repaired_sha256"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for (conv,), held in _grouped(batches, 1):
            cost, audit = derive([r for _, role, _, copies, head in held for r in _agenda_rows(role, head, copies)], goals="0a")["end"]
            lines = "\n".join(apply_edits(audit, ((role, text, copies) for _, role, text, copies, _ in held)))
            out.append((conv, illegal_pairs((role[:1], copies) for _, role, _, copies, _ in held), cost, audit, hashlib.sha256(lines.encode()).hexdigest()))
            if len(out) >= 1000:
                yield _table(out, names, types)
                out = []
        yield _table(out, names, types)

    rows = rows.select("conv_id", "turn", "role", "text", "copies", "head").repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return rows.mapInArrow(run, _RESULT)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each stretch from every state to every state: rows (from, to, cost, audit)
    and one with its illegal pairs and its first and last initial."""
    for (conv, part), held in _grouped(batches, 2):
        rows = [r for _, role, copies, head in held for r in _agenda_rows(role, head, copies)]
        out = [(conv, part, p + q, value[0], value[1]) for p in "0sua" for q, value in derive(rows, p).items()]
        out.append((conv, part, "", illegal_pairs((role[:1], copies) for _, role, copies, _ in held), held[0][1][:1] + "\n" + held[-1][1][:1]))
        yield _table(out, ["conv_id", "part", "ends", "cost", "audit"], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a conversation in order into one; gives the stretches' edits
    (part, state before, edits) and, with part -1, illegal pairs and cost."""
    def close(conv: int | None) -> pa.RecordBatch:
        cost, _, path = min(best[q] for q in "0a" if q in best)
        out = [(conv, -1, "", "", illegal, cost)]
        while path is not None:
            path, part, p, audit = path
            out.append((conv, part, p, audit, None, None))
        return _table(out, ["conv_id", "part", "state", "audit", "illegal", "cost"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()])

    now, best, illegal, last = None, {}, 0, None
    for (conv, part), held in _grouped(batches, 2):
        if now is None or now != (conv,):
            if now is not None:
                yield close(*now)
            now, best, illegal, last = (conv,), {"0": (0, "", None)}, 0, None
        after: dict = {}
        for ends, cost, audit in held:
            if not ends:
                first, final = audit.split("\n", 1) if not audit.startswith("\n\n") else ("\n", audit[2:])
                illegal += cost + (last is not None and last + first not in ("su", "ua", "au"))
                last = final
            elif ends[0] in best:
                c, tail, path = best[ends[0]]
                found = (c + cost, tail + audit)
                if ends[1] not in after or found < after[ends[1]][:2]:
                    after[ends[1]] = (*found, (path, part, ends[0], audit))
        settled = len(os.path.commonprefix([v[1] for v in after.values()]))
        best = {q: (c, tail[settled:], path) for q, (c, tail, path) in after.items()}
    if now is not None:
        yield close(*now)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired text of each stretch (null: no line)."""
    for (conv, part, state, audit), held in _grouped(batches, 4):
        lines = list(apply_edits(audit, ((role, text, copies) for _, role, text, copies in held), state))
        yield _table([(conv, part, "\n".join(lines).encode() if lines else None)], ["conv_id", "part", "lines"], [pa.int64(), pa.int64(), pa.binary()])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's stretches, streamed in order."""
    names, types = ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()]
    now, sha, some = None, None, False
    for batch in batches:
        for conv, lines in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if now != (conv,):
                if now is not None:
                    yield _table([(*now, sha.hexdigest())], names, types)
                now, sha, some = (conv,), hashlib.sha256(), False
            if lines is not None:
                sha.update(b"\n" + lines if some else lines)
                some = True
    if now is not None:
        yield _table([(*now, sha.hexdigest())], names, types)


def repair_long(rows: DataFrame) -> DataFrame:
    """Conversations that no task should hold: by stretches."""
    key = ["conv_id", *_ORDER]
    width = 1 << STRETCH_BITS
    placed = (rows.select("conv_id", "turn", "role", "text", "copies", "head").repartitionByRange(*key).sortWithinPartitions(*key)
              .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.floor(F.col("at") / width).cast("long")))
    placed = stored(placed, "placed")

    def by_stretch(df: DataFrame, *more: str) -> DataFrame:
        keys = ["conv_id", "part", *more]
        return df.repartition("conv_id", "part").sortWithinPartitions(*keys, "at")

    spans = by_stretch(placed.select("conv_id", "part", "at", "role", "copies", "head")).mapInArrow(
        _spans, "conv_id long, part long, ends string, cost long, audit string")
    chain = stored(spans.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        _chain, "conv_id long, part long, state string, audit string, illegal long, cost long"), "chain")
    edits = chain.where("part >= 0").select(F.col("conv_id").alias("c_"), F.col("part").alias("p_"), "state", "audit")
    both = placed.join(edits, F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("part") == F.col("p_")))
    texts = by_stretch(both.select("conv_id", "part", "state", "audit", "at", "role", "text", "copies"), "state", "audit").mapInArrow(
        _written, "conv_id long, part long, lines binary")
    shas = (texts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
            .withColumnRenamed("conv_id", "h_"))
    audits = (chain.groupBy("conv_id").agg(F.max("illegal").alias("illegal"), F.max("cost").alias("cost"),
                                           F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda s: s["audit"])).alias("audit")))
    return (audits.join(shas, F.col("conv_id").eqNullSafe(F.col("h_")))
            .select("conv_id", "illegal", "cost", "audit", "repaired_sha256"))


def _count(fault: str) -> Column:
    return F.sum((F.col("head").eqNullSafe(F.lit(fault))).cast("long") + F.when(F.col("rest") == fault, F.col("copies") - 1).otherwise(0)).alias(fault)


def repair(conversations: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """A row for every conv_id of ``conversations``, with the faults of its
    ``damaged`` rows (by default :func:`damage`) and their cheapest repair."""
    spark = conversations.sparkSession
    ready(spark)
    rows = stored(faults(damage(conversations) if damaged is None else damaged), "faults")
    gaps = (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")
    turns = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"),
                                                *[_count(f) for f in FAULTY])
    stats = stored(turns.groupBy("conv_id").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), gaps, *[F.sum(f).alias(f) for f in FAULTY]), "stats")
    big = stats.where((F.col("n") > LONG) | (F.col("chars") > LONG_CHARS)).select(F.col("conv_id").alias("b_"))
    same = F.col("conv_id").eqNullSafe(F.col("b_"))
    if big.isEmpty():
        fixed = repair_short(rows)
    else:
        big = stored(big, "long")
        fixed = repair_short(rows.join(big, same, "left_anti")).unionByName(repair_long(rows.join(big, same, "left_semi")))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    stats = stats.withColumnRenamed("conv_id", "s_").drop("n", "chars")
    fixed = fixed.withColumnRenamed("conv_id", "f_")
    out = every.join(stats, F.col("conv_id").eqNullSafe(F.col("s_")), "left").join(fixed, F.col("conv_id").eqNullSafe(F.col("f_")), "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *FAULTY, "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
