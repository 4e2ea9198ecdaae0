"""Personal data: patterns propose, checksums confirm, context adjusts (operator 2).

Four base kinds are found exactly as their patterns say (leftmost, not
overlapping within a kind; a proposal that fails its test is dropped): email,
ip (parts at most 255), card (16 to 19 digits passing Luhn), phone (8 to 15
digits).  The method adds kinds that need more evidence: iban (mod-97), ssn
(number ranges), card_short (13 to 15 digits passing Luhn) and phone_local.
Each proposal starts from its kind's score, a passed checksum adds to it, words
near it add or take away; added kinds need REQUIRED and must not overlap
another span.  Positions are code points, ends exclusive.

The patterns are arranged so that a text is scanned in linear time: an email is
looked for from its ``@``, a number from the start of its digits.

Null text counts as empty; repeated rows get equal spans; an empty table gives
no rows; extra columns are not read by ``find`` and pass through ``redact``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import column_values, documents, ready

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "card_short", "phone_local")
KINDS = BASE_KINDS + ADDED_KINDS
REQUIRED = 0.5
BEFORE, AFTER = 48, 24

# Base patterns as the contract gives them, anchored where a match can start.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]+")

# Score before evidence, what a passed checksum adds, words that speak for and against.
_PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.3, "ssn": 0.3, "card_short": 0.2, "phone_local": 0.3}
_CHECKED = {"card": 0.4, "iban": 0.5, "card_short": 0.2}
_FOR = {
    "email": "email mail e contact contacto correo courriel write", "ip": "ip address host server adresse",
    "card": "card credit visa mastercard payment carte tarjeta karte", "phone": "phone tel call mobile fax telefon telefono",
    "iban": "iban account konto compte cuenta bank", "ssn": "ssn social security",
    "card_short": "card credit amex payment carte tarjeta karte", "phone_local": "phone tel call mobile fax telefon telefono",
}
_AGAINST = {"ip": "version release section", "card": "order invoice isbn tracking serial", "ssn": "order part serial version",
            "card_short": "order invoice isbn tracking serial", "phone_local": "order invoice isbn tracking serial",
            "phone": "order invoice", "iban": "serial"}
_FOR, _AGAINST = ({k: frozenset(v.split()) for k, v in x.items()} for x in (_FOR, _AGAINST))


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        start = at = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = m.end()
            yield start, done


def _matches(pattern: re.Pattern, holds: Callable[[str], bool]) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text) if holds(m.group()))


def _digits(least: int, most: int, check: Callable[[str], bool] | None = None) -> Callable[[str], bool]:
    def holds(s: str) -> bool:
        d = _NOT_DIGIT.sub("", s)
        return least <= len(d) <= most and (check is None or check(d))
    return holds


def _ip_parts(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _ssn_ranges(s: str) -> bool:
    area, group, serial = s.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


_FINDERS = {
    "email": _emails, "ip": _matches(_IP, _ip_parts), "card": _matches(_CARD, _digits(16, 19, luhn)),
    "phone": _matches(_PHONE, _digits(8, 15)), "iban": _matches(_IBAN, mod97), "ssn": _matches(_SSN, _ssn_ranges),
    "card_short": _matches(_CARD, _digits(13, 15, luhn)), "phone_local": _matches(_LOCAL_PHONE, lambda s: True),
}


def score(kind: str, text: str, start: int, end: int) -> float:
    near = _WORD.findall(f"{text[max(0, start - BEFORE):start]} {text[end:end + AFTER]}".lower())
    s = _PRIOR[kind] + _CHECKED.get(kind, 0)
    s += 0.3 if not _FOR[kind].isdisjoint(near) else 0
    s -= 0.3 if not _AGAINST.get(kind, frozenset()).isdisjoint(near) else 0
    return round(min(max(s, 0.0), 1.0), 3)


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start."""
    text = text or ""
    out = [(kind, a, b, score(kind, text, a, b)) for kind in BASE_KINDS for a, b in _FINDERS[kind](text)]
    for kind in ADDED_KINDS:   # matches of one kind never overlap each other, only those before
        taken = sorted((a, b) for _, a, b, _ in out)
        starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
        for a, b in _FINDERS[kind](text):
            before = bisect_left(starts, b)   # spans that begin before this one ends; the farthest end of them decides
            if (not before or reach[before - 1] <= a) and (s := score(kind, text, a, b)) >= REQUIRED:
                out.append((kind, a, b, s))
    return out


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): every span of every text."""
    ready(docs.sparkSession)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans(t)]
                     for t in column_values(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")),
                                              pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    return documents(docs).mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, end long, score double>>")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document, and their scores in order."""
    f = find(docs)
    listed = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return f.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(listed(base), 256).alias("base_sha256"),
                    listed(F.col("spans")).alias("spans"), F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))


def mask(text: str) -> str:
    """The text with every span (overlapping ones as one) replaced by its kind."""
    out, done = [], 0
    for kind, a, b, _ in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, personal data masked; ``n_chars`` follows the text."""
    ready(docs.sparkSession)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else mask(t) for t in texts.tolist()], dtype=object)

    out = docs.withColumn("text", masked(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull() & F.col("text").isNotNull(),
                                               F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out
