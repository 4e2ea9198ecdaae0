"""Sums over daily snapshots, a row for each pair and month.

:func:`by_month` lays out every day of every stretch (see :mod:`stockflow.operators.ledger`)
as :func:`ledger.daily` does, but as numpy arrays inside the task, a bounded number of days
at a time, and adds the days up where they are.  A day so takes some array cells and no Spark
row of its own; rows come out of a task by month.  Spark deals the stretches: those of a
pair's year lie in one task, in order (a window numbers them, which costs no shuffle where
they are dealt by the pair already).

Sums keep to SQL's rules: unknown (null) values are left out, and a sum of nothing but
unknown values is unknown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.operators import ledger

# Days that a task lays out at a time.
DAYS_AT_ONCE = 131_072
# Sums over a month stay within 64 bits where opening stock and restocks are below this.
_MOST = 2 ** 62 // 1000
_NUMBER = "__number"


class Stretches:
    """Some stretches: ``keys`` and other texts as they are, and number columns as arrays (zero
    where null, and where they are known; null: everywhere)."""

    def __init__(self, keys: dict[str, pa.Array], numbers: dict[str, tuple[np.ndarray, np.ndarray | None]]):
        self.keys, self.numbers = keys, numbers

    @classmethod
    def of(cls, rows: pa.Table) -> Stretches:
        plain = {f.name for f in rows.schema if f.name in ledger.PAIR or pa.types.is_string(f.type)}
        return cls({k: rows[k].combine_chunks() for k in rows.column_names if k in plain},
                   {k: cls._number(rows[k].combine_chunks()) for k in rows.column_names if k not in plain})

    @staticmethod
    def _number(column: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
        if not column.null_count:
            return column.to_numpy(zero_copy_only=False), None
        return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)

    def take(self, at: np.ndarray) -> Stretches:
        return Stretches({k: v.take(pa.array(at)) for k, v in self.keys.items()},
                         {k: (v[at], known if known is None else known[at]) for k, (v, known) in self.numbers.items()})


class Calendar:
    """What the days counted from ``day0`` are, by their number, and room for some days."""

    def __init__(self, day0: str, restock_every: int):
        self.day0, self.every, self.n, self.room = np.datetime64(date.fromisoformat(day0), "D"), restock_every, 0, []

    def upto(self, n: int) -> Calendar:
        if n > self.n:
            self.day = np.arange(n)
            dates = self.day0 + self.day
            months = dates.astype("datetime64[M]")
            since = months.astype(np.int64)
            self.month = (since // 12 + 1970) * 100 + since % 12 + 1   # yyyymm
            self.of_month = (dates - months).astype(np.int64) + 1
            self.restocks = self.day // self.every + 1
            self.due = (self.day % self.every == 0).astype(np.int64)
            self.n = n
        return self

    def space(self, k: int, shape: tuple[int, int]) -> np.ndarray:
        """The ``k``-th room for days, used again for the next ones: fresh memory costs more than the sums."""
        while len(self.room) <= k:
            self.room.append(np.empty(0, np.int64))
        if self.room[k].size < shape[0] * shape[1]:
            self.room[k] = np.empty(shape[0] * shape[1], np.int64)
        return self.room[k][:shape[0] * shape[1]].reshape(shape)


class Days:
    """The same days of some pairs, a row a pair: ``stock`` and ``restock`` (zero where unknown, see
    ``stock_known`` and ``restock_known``; null: all are known), and by column ``day`` and
    ``of_month``.  ``pair`` gives a number of the pairs; the sums are by pair and month."""

    def __init__(self, rows: Stretches, begins: np.ndarray, calendar: Calendar):
        first, after, stock, rate, own = (rows.numbers[name][0] for name in ("i", "next_i", "stock_level", "rate", "restock"))
        some = slice(int(first[0]), int(after[-1]))
        calendar.upto(some.stop)
        self.rows, self.begins, self.calendar, self.span = rows, begins, calendar, after - first
        self.shape = shape = len(begins), some.stop - some.start
        most = lambda x: max(int(x.max()), -int(x.min()))
        if max(most(stock), most(own), most(rate) * (shape[1] + 1)) > _MOST:
            raise OverflowError("stock beyond 64-bit sums")
        self.day, self.of_month = calendar.day[some], calendar.of_month[some]
        due, restocks = calendar.due[some], calendar.restocks[some]
        rates = rate[begins][:, None]
        if not (rate == np.repeat(rates[:, 0], np.diff(begins, append=len(rate)))).all():
            rates = self.spread(rate)
        self.stock, self.restock = self.spread(stock - rate * calendar.restocks[first]), calendar.space(0, shape)
        self.stock += np.multiply(rates, restocks, out=self._scratch())
        np.multiply(rates, due, out=self.restock)
        firsts = np.cumsum(self.span) - self.span
        self.restock.ravel()[firsts] = own
        self.stock_known, self.restock_known = self._known("stock_level", "rate"), None
        own_known, rated = rows.numbers["restock"][1], self._known("rate")
        if own_known is not None or rated is not None:
            self.restock_known = np.ones(shape, bool) if rated is None else rated | (due == 0)
            self.restock_known.ravel()[firsts] = True if own_known is None else own_known
        for values, known in ((self.stock, self.stock_known), (self.restock, self.restock_known)):
            if known is not None:
                values[~known] = 0
        month = calendar.month[some]
        self.groups = np.flatnonzero(np.diff(month, prepend=0))   # where a month begins
        self.months = month[self.groups]
        self.n_days = np.diff(self.groups, append=shape[1])
        self.pairs = pa.array(np.repeat(begins, len(self.groups)))

    def space(self, k: int) -> np.ndarray:
        """Room for whole numbers of these days (``k`` 0 or 1)."""
        return self.calendar.space(2 + k, self.shape)

    def _scratch(self) -> np.ndarray:
        return self.calendar.space(1, self.shape)

    def spread(self, by_stretch: np.ndarray) -> np.ndarray:
        return np.repeat(by_stretch, self.span).reshape(self.shape)

    def _known(self, *names: str) -> np.ndarray | None:
        some = [known for known in (self.rows.numbers[name][1] for name in names) if known is not None]
        return self.spread(np.logical_and.reduce(some)) if some else None

    def pair(self, name: str) -> tuple[np.ndarray, np.ndarray | None]:
        """A number column of the stretches that is the pair's (zero where unknown), and where it is known."""
        values, known = self.rows.numbers[name]
        return values[self.begins][:, None], None if known is None else known[self.begins][:, None]

    def keys(self) -> dict[str, pa.Array]:
        return {**{k: self.rows.keys[k].take(self.pairs) for k in ledger.PAIR}, "month": self._each(self.months.astype(np.int32))}

    def text(self, prefix: str, number: np.ndarray) -> pa.Array:
        """The pairs' text ``prefix`` before a number of each month."""
        return pc.binary_join_element_wise(self.rows.keys[prefix].take(self.pairs), self._each(number).cast(pa.string()), "")

    def _each(self, of_month: np.ndarray) -> pa.Array:
        return pa.array(np.tile(of_month, self.shape[0]))

    def count(self) -> pa.Array:
        return self._each(self.n_days)

    def first_day(self) -> np.ndarray:
        """yyyymmdd of a month's first day here."""
        return self.months * 100 + self.of_month[self.groups]

    def last_day(self) -> np.ndarray:
        return self.months * 100 + self.of_month[self.groups + self.n_days - 1]

    def _given(self, sums: np.ndarray, known: np.ndarray | None) -> pa.Array:
        nothing = None if known is None else np.add.reduceat(known.astype(np.int64), self.groups, axis=1).ravel() == 0
        return pa.array(sums.ravel(), mask=nothing)

    def total(self, values: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
        if known is not None:
            values = np.where(known, values, 0)
        return self._given(np.add.reduceat(values, self.groups, axis=1), known)

    def by_day(self, values: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
        """Sum of whole numbers, each times its day of the month."""
        return self.total(np.multiply(values, self.of_month, out=self._scratch()), known)

    def least(self, values: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
        if known is not None:
            values = np.where(known, values, np.iinfo(values.dtype).max)
        return self._given(np.minimum.reduceat(values, self.groups, axis=1), known)

    def most(self, values: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
        if known is not None:
            values = np.where(known, values, np.iinfo(values.dtype).min)
        return self._given(np.maximum.reduceat(values, self.groups, axis=1), known)


def snapshot_sums(days: Days) -> dict[str, pa.Array]:
    """Sums that change if any day's snapshot does, and the first and last snapshot's id, of which
    the stretches have what comes before the day (``id_prefix``)."""
    return {"n_days": days.count(), "first_id": days.text("id_prefix", days.first_day()), "last_id": days.text("id_prefix", days.last_day()),
            "stock": days.total(days.stock, days.stock_known),
            "stock_by_day": days.by_day(days.stock, days.stock_known),
            "least_stock": days.least(days.stock, days.stock_known),
            "restocked": days.total(days.restock, days.restock_known),
            "restocked_by_day": days.by_day(days.restock, days.restock_known)}


SNAPSHOT_SUMS = ("n_days bigint, first_id string, last_id string, stock bigint, stock_by_day bigint, least_stock bigint, "
                 "restocked bigint, restocked_by_day bigint")


def _same_days(batches: Iterator[pa.RecordBatch], calendar: Calendar) -> Iterator[Days]:
    """The days of pairs' whole years, those of the same year (first and last day) together."""
    def lots(rows: pa.Table, begins: np.ndarray) -> Iterator[Days]:
        if not rows.num_rows:
            return
        whole, counts = Stretches.of(rows), np.diff(begins, append=rows.num_rows)
        first, after = whole.numbers["i"][0], whole.numbers["next_i"][0]
        follows = first[1:] == after[:-1]
        follows[begins[1:] - 1] = True
        if not follows.all():
            raise ValueError("a pair's stretches of a year do not follow on each other")
        years = np.stack([first[begins], after[begins + counts - 1]], axis=1)
        for year in np.unique(years, axis=0):
            of_year = np.flatnonzero((years == year).all(axis=1))
            most = max(1, DAYS_AT_ONCE // int(year[1] - year[0]))
            for lot in np.split(of_year, range(most, len(of_year), most)):
                n = counts[lot]
                at = np.cumsum(n) - n
                yield Days(whole.take(np.arange(n.sum()) + np.repeat(begins[lot] - at, n)), at, calendar)

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        begins = np.flatnonzero(rows[_NUMBER].to_numpy() == 1)
        rest = rows.slice(begins[-1])   # more of it may come
        yield from lots(rows.slice(0, begins[-1]), begins[:-1])
    if rest is not None:
        yield from lots(rest, np.zeros(1, np.int64))


def by_month(stretches: DataFrame, day0: str, sums: Callable[[Days], dict[str, pa.Array]], schema: str,
             restock_every: int = ledger.RESTOCK_EVERY) -> DataFrame:
    """(pair, month as yyyymm, and ``schema``): ``sums`` of all daily snapshots of ``stretches``
    (:data:`ledger.STRETCH_COLUMNS`, ``year`` and what ``sums`` uses; none crosses a new year, and
    those of a pair's year follow on each other)."""
    of_year = Window.partitionBy(*ledger.PAIR, "year").orderBy("i")
    rows = (stretches.withColumns({"i": F.col("i").cast("bigint"), "next_i": F.col("next_i").cast("bigint"), "rate": F.col("rate").cast("bigint")})
            .withColumn(_NUMBER, F.row_number().over(of_year)).sortWithinPartitions(*ledger.PAIR, "year", "i"))
    types = dict(stretches.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        calendar = Calendar(day0, restock_every)
        for days in _same_days(batches, calendar):
            out = {**days.keys(), **sums(days)}
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return rows.mapInArrow(run, ", ".join([*(f"{k} {types[k]}" for k in ledger.PAIR), "month int", schema]))
