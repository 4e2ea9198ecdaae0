"""Roles and turns of plain transcripts, by a hidden Markov model (operator 1).

A transcript is lines in order.  Each line shows a symbol: what speaker marker
it opens with, if any, and its shape.  The hidden state of a line is its role
and whether it begins a turn, goes on with one or is a gap in it.  Viterbi's best path gives
the roles, also where markers are missing, odd or misleading; turns are then
rendered in one canonical form with their markers taken off.

The model (start, transition and symbol probabilities) is counted from
transcripts whose roles are known.

A conversation may be any share of the table: lines are range-partitioned by
conversation and position, so a long one spans many tasks.  A task sums up the
conversations at its two ends as a matrix (the best score from any state before
its lines to any state at their end); chaining the matrices fixes the states at
the seams, at most two rows a task; then every task decodes its lines exactly.
Pieces of a turn that crosses seams are put together afterwards, so a turn is one
row and the result does not depend on the number of tasks.

Null text is an empty line; null conv_id or positions sort first, and all rows
without conv_id are one transcript; equal positions are ordered by their text
and then as they lie.  Unknown or null roles teach nothing.  Without any known
role the model is uniform.  An empty table gives no rows.  Other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import ready, stored

ROLES = ("system", "user", "assistant")
PARTS = ("begin", "inside", "gap")   # of a turn; a gap is a blank line in it or after it
STATES = [(role, part) for role in ROLES for part in PARTS]
# Names that speakers go by.
NAMES = {"system": "system instruction instructions context", "user": "user human customer question q me",
         "assistant": "assistant ai bot model answer a agent"}
_NAME = {n: role for role, names in NAMES.items() for n in names.split()}
MARKERS = (None, *ROLES, "other")
SHAPES = ("blank", "question", "list", "short", "middle", "long")
N_SYMBOLS = len(MARKERS) * len(SHAPES)
SMOOTHING = 0.5
_MARKER = re.compile(r"\s*(?P<open>[#*\[<|(]+\s*)?(?P<name>[A-Za-z]{1,14})(?P<close>\s*[\]|>)*]+)?(?P<colon>\s*:)?(?P<rest>\s|$)")
_LIST = re.compile(r"\s*(?:[-*+] |\d+[.)] |```)")


def marker(line: str) -> tuple[str | None, int]:
    """(role the opening marker names, or other, or none; where the text goes on)."""
    m = _MARKER.match(line)
    if not m or not (m["colon"] or m["close"] or (m["open"] and "#" in m["open"])):
        return None, 0
    role = _NAME.get(m["name"].lower())
    if role is None and not (m["colon"] and m["name"][0].isupper()):
        return None, 0
    return role or "other", m.end()


def symbol(line: str | None) -> int:
    line = line or ""
    kind, at = marker(line)
    body = line[at:].strip()
    shape = ("blank" if not body else "question" if body.endswith("?") else "list" if _LIST.match(line[at:])
             else "short" if len(body) < 40 else "middle" if len(body) < 200 else "long")
    return MARKERS.index(kind) * len(SHAPES) + SHAPES.index(shape)


def symbols(line: str) -> Column:
    @F.pandas_udf("int")
    def shown(lines: pd.Series) -> pd.Series:
        return pd.Series([symbol(x) for x in lines.tolist()], dtype="int32")

    return shown(line)


class Hmm:
    """Log probabilities: start, step (from, to), show (state, symbol)."""

    def __init__(self, start: np.ndarray, step: np.ndarray, show: np.ndarray):
        self.start, self.step, self.show = start, step, show

    def forward(self, shown: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Best scores at the last line, and each line's best predecessors.
        ``before``: scores of the state before the first line (none: it starts)."""
        back = np.zeros((len(shown), len(STATES)), dtype=np.int8)
        score = self.start + self.show[:, shown[0]] if before is None else None
        for k, s in enumerate(shown):
            if k or before is not None:
                ways = (before if k == 0 else score)[:, None] + self.step
                back[k] = ways.argmax(axis=0)
                score = ways.max(axis=0) + self.show[:, s]
        return score, back

    def matrix(self, shown: np.ndarray) -> np.ndarray:
        """(state before, state at the end) -> best score; row -1 if it starts here."""
        rows = []
        for s in range(len(STATES)):
            before = np.full(len(STATES), -np.inf)
            before[s] = 0
            rows.append(self.forward(shown, before)[0])
        return np.array([*rows, self.forward(shown, None)[0]])

    def path(self, shown: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
        v = None
        if before is not None:
            v = np.full(len(STATES), -np.inf)
            v[before] = 0
        score, back = self.forward(shown, v)
        out = np.empty(len(shown), dtype=np.int64)
        out[-1] = int(score.argmax()) if last is None else last
        for k in range(len(shown) - 1, 0, -1):
            out[k - 1] = back[k, out[k]]
        return out


def fit(turns: DataFrame) -> Hmm:
    """Count the model from (conv_id, turn, role, lines): the lines of each
    turn as an array.  Only counts come to the driver."""
    ready(turns.sparkSession)
    t = turns.where(F.col("role").isin(*ROLES) & (F.size("lines") > 0)).withColumn("parts", F.transform(
        "lines", lambda x, i: F.when(i == 0, PARTS[0]).when(F.trim(x) == "", PARTS[2]).otherwise(PARTS[1])))
    shown = (t.select("role", F.posexplode("lines").alias("k", "line"), "parts")
             .select("role", F.get("parts", F.col("k")).alias("part"), symbols("line").alias("symbol"))
             .groupBy("role", "part", "symbol").count().collect())
    n = F.size("parts") - 1
    inner = (t.select("role", F.explode(F.arrays_zip(F.slice("parts", 1, n).alias("a"), F.slice("parts", 2, n).alias("b"))).alias("p"))
             .groupBy("role", "p.a", "p.b").count().collect())
    ends = t.groupBy("role", F.element_at("parts", -1).alias("part")).count().collect()
    one = t.groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    ahead = one.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    order = one.join(ahead, ["conv_id", "turn"], "left").groupBy("before", "role").count().collect()
    at, size = {s: k for k, s in enumerate(STATES)}, len(STATES)
    start, step, show = np.full(size, 1e-3), np.full((size, size), 1e-3), np.full((size, N_SYMBOLS), SMOOTHING)
    begins = {a: dict.fromkeys(ROLES, SMOOTHING) for a in ROLES}
    for r in shown:
        show[at[r["role"], r["part"]], r["symbol"]] += r["count"]
    for r in inner:
        step[at[r["role"], r["a"]], at[r["role"], r["b"]]] += r["count"]
    for r in order:
        if r["before"] is None:
            start[at[r["role"], PARTS[0]]] += r["count"]
        else:
            begins[r["before"]][r["role"]] += r["count"]
    for r in ends:
        total = sum(begins[r["role"]].values())
        for after, c in begins[r["role"]].items():
            step[at[r["role"], r["part"]], at[after, PARTS[0]]] += r["count"] * c / total
    return Hmm(*[np.log(x / x.sum(axis=-1, keepdims=True)) for x in (start, step, show)])


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pd.DataFrame]:
    """Rows of one value of ``column`` at a time, from sorted batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        rows = batch.to_pandas()
        if not len(rows):
            continue
        cuts = np.flatnonzero(rows[column].to_numpy()[1:] != rows[column].to_numpy()[:-1]) + 1
        for k, piece in enumerate(np.split(np.arange(len(rows)), cuts)):
            part = rows.iloc[piece]
            if held and (k or held[-1][column].iloc[0] != part[column].iloc[0]):
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def _runs(rows: pd.DataFrame) -> list[tuple[int, int]]:
    """Consecutive lines of one conversation (null is one too)."""
    conv = rows["conv"].to_numpy()
    cuts = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), len(rows)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def seams(edges: list, hmm: Hmm) -> dict[tuple[int, str], tuple[int | None, int | None]]:
    """(task, conversation) -> states before and at the end of its lines there,
    for conversations in several tasks.  ``edges``: (part, conv, matrix)."""
    out = {}
    by_conv: dict[str, list] = {}
    for part, conv, m in sorted(edges, key=lambda e: e[0]):
        by_conv.setdefault(conv, []).append((part, np.array(m).reshape(len(STATES) + 1, len(STATES))))
    for conv, chain in by_conv.items():
        if len(chain) > 1:
            scores = [chain[0][1][-1]]
            ways = []
            for _, m in chain[1:]:
                w = scores[-1][:, None] + m[:-1]
                ways.append(w.argmax(axis=0))
                scores.append(w.max(axis=0))
            state = int(scores[-1].argmax())
            for k in range(len(chain) - 1, -1, -1):
                before = int(ways[k - 1][state]) if k else None
                out[chain[k][0], conv] = (before, state)
                state = before
    return out


def parse(lines: DataFrame, hmm: Hmm) -> DataFrame:
    """Turns of transcripts given as (conv_id long, position..., line): columns
    ``major`` and ``minor`` order the lines.  One row per turn, whatever tasks its
    lines were in: conv_id, major and minor of its first line, role, n_lines,
    rendered."""
    spark = lines.sparkSession
    ready(spark)
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    placed = (lines.select(F.col("conv_id").cast("long").alias("conv_id"), key.alias("conv"), "major", "minor",
                           F.coalesce("line", F.lit("")).alias("line"), symbols("line").alias("symbol"),
                           F.monotonically_increasing_id().alias("lie")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "major", "minor", "line", "lie")]
    sorted_ = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    table = stored(sorted_.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id()), "lines")
    dealt = table.repartition("part").sortWithinPartitions("part", "pos")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "part"):
            runs = _runs(rows)
            shown = rows["symbol"].to_numpy()
            for a, z in {runs[0], runs[-1]}:
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([int(rows["part"].iloc[0])], pa.int32()), "conv": [rows["conv"].iloc[a]],
                     "matrix": [hmm.matrix(shown[a:z]).ravel().tolist()]})

    edges = dealt.select("part", "conv", "symbol").mapInArrow(ends, "part int, conv string, matrix array<double>")
    fixed = seams([(r["part"], r["conv"], r["matrix"]) for r in edges.collect()], hmm)   # two rows a task

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "part"):
            part, shown, text = int(rows["part"].iloc[0]), rows["symbol"].to_numpy(), rows["line"].tolist()
            conv_id, conv = rows["conv_id"].tolist(), rows["conv"].tolist()
            major, minor, out = rows["major"].tolist(), rows["minor"].tolist(), []
            for a, z in _runs(rows):
                before, end = fixed.get((part, conv[a]), (None, None))
                states = hmm.path(shown[a:z], before, end)
                begins = [k for k in range(z - a) if k == 0 or STATES[states[k]][1] == PARTS[0]]
                for b, e in zip(begins, [*begins[1:], z - a], strict=True):
                    role, opens = STATES[states[b]][0], STATES[states[b]][1] == PARTS[0]
                    body = text[a + b:a + e]
                    if opens:
                        body[0] = body[0][marker(body[0])[1]:]
                    goes_on = b == 0 and before is not None and not opens
                    out.append((conv_id[a], part, a + b, major[a + b], minor[a + b], role, goes_on, a + b == 0 or a + e == len(rows), e - b, "\n".join(body)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([None if t == pa.int64() and pd.isna(x) else int(x) if t == pa.int64() else x for x in c], t)
                                              for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=PIECE.replace(",", "").split()[::2])

    pieces = stored(dealt.select("part", "conv_id", "conv", "major", "minor", "line", "symbol").mapInArrow(decode, PIECE), "pieces")
    return _turns(pieces)


PIECE = ("conv_id long, part int, first long, major long, minor long, role string, goes_on boolean, at_seam boolean, "
         "n_lines long, body string")


def _turns(pieces: DataFrame) -> DataFrame:
    """Pieces of turns that tasks divided are put together again.  Only the first and
    last piece of a task can be such, so what is ordered is two rows a task."""
    seam = pieces.where("at_seam").select("conv_id", "part", "first", "goes_on")
    order = Window.partitionBy("conv_id").orderBy("part", "first")
    opened = F.last(F.when(~F.col("goes_on"), F.struct("part", "first")), ignorenulls=True).over(order)
    anchors = seam.withColumn("anchor", opened).where("goes_on").select(F.col("part").alias("p_"), F.col("first").alias("f_"), "anchor")
    anchored = (pieces.join(anchors, (F.col("part") == F.col("p_")) & (F.col("first") == F.col("f_")), "left")
                .withColumn("anchor", F.coalesce("anchor", F.struct("part", "first"))).drop("p_", "f_"))
    divided = anchors.select("anchor").distinct().select(F.col("anchor.part").alias("p_"), F.col("anchor.first").alias("f_"))
    same = (F.col("anchor.part") == F.col("p_")) & (F.col("anchor.first") == F.col("f_"))
    whole = anchored.join(divided, same, "left_anti").select("conv_id", "major", "minor", "role", "n_lines", "body")
    piece = F.struct("part", "first", "conv_id", "major", "minor", "role", "n_lines", "body")
    joined = (anchored.join(divided, same, "left_semi").groupBy("anchor").agg(F.array_sort(F.collect_list(piece)).alias("all"))
              .select(*[F.col("all")[0][c].alias(c) for c in ("conv_id", "major", "minor", "role")],
                      F.aggregate("all", F.lit(0).cast("long"), lambda n, x: n + x["n_lines"]).alias("n_lines"),
                      F.array_join(F.transform("all", lambda x: x["body"]), "\n").alias("body")))
    body = F.trim("body", F.lit("\n"))   # canonical: a header, the text without blank lines around it
    return whole.unionByName(joined).select("conv_id", "major", "minor", "role", "n_lines",
                                            F.concat(F.lit("<|"), "role", F.lit("|>\n"), body, F.lit("\n")).alias("rendered"))
