"""Daily stock ledger: a running balance that can never go below zero.

For every stocked (product, warehouse) pair and every day of a range::

    sold_t    = units ordered that day at that warehouse (every status)
    restock_t = restock_qty on every ``restock_every``-th day (day 0 included)
    stock_t   = max(0, stock_{t-1} - sold_t + restock_t),  stock_{-1} = initial

The clamp makes it a recursion, but it has a closed form (a Lindley
recursion): with ``x_t = initial + Σ_{i<=t}(restock_i - sold_i)``,
``stock_t = x_t - min(0, min_{i<=t} x_i)``.  Both terms are running window
aggregates with the same frame, so one sort serves them.

The balance is kept as **stretches**, not as days: a stretch runs from an *event*
day (a day with sales, the first day of a year) to the day before the next event and
says the stock and restock of its first day and what every restock day inside it
adds.  Between two events the balance only grows, so the minimum is met on an event
day.  (A pair whose restock is negative or unknown has an event on every restock day.)
Physical shape:

* units per pair-day are aggregated (map-side partial aggregation, so a hot
  pair is combined before the shuffle);
* one shuffle deals events by the pair; the running windows sort events (sale days
  and years of a pair), neither the restock days nor the calendar grid;
* :func:`daily` explodes every stretch into the days it covers (``sequence``): no cross
  join, no sort and no shuffle of the daily rows, which are sized by
  ``partitions`` (rows per task of the output).  Stores keep the stretches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions.calendar import date_key
from stockflow.operators.ranking import global_rank

LEDGER_COLUMNS = ["inventory_id", "date", "product_id", "warehouse_id", "stock_level", "restock_qty"]

# Fixed value: restock cadence of the reference's inventory (every 14th day).
RESTOCK_EVERY = 14
# Daily rows that a task makes (one at a time, or some as arrays), and events that it sorts.
ROWS_PER_PARTITION = 40_000_000
EVENTS_PER_PARTITION = 1_000_000

PAIR = ["product_id", "warehouse_id"]
STRETCH_COLUMNS = [*PAIR, "i", "next_i", "stock_level", "restock", "rate"]


def inventory_key(product: str, warehouse: str, date_id: Column) -> Column:
    """Snapshot row id ``INV-<product>-<warehouse>-<yyyymmdd>``: a pure
    function of the natural key, so stores may keep the natural key only and
    derive the id when it is read."""
    return F.concat(F.lit("INV-"), F.col(product).cast("string"), F.lit("-"),
                    F.col(warehouse).cast("string"), F.lit("-"), date_id.cast("string"))


def daily_units(orders: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Units ordered per product × warehouse × day (the keyed lookup of sales)."""
    d = F.to_date("order_date")
    o = orders
    if start is not None:
        o = o.where(d >= F.to_date(F.lit(start)))
    if end is not None:
        o = o.where(d <= F.to_date(F.lit(end)))
    return (o.groupBy("product_id", "warehouse_id", d.alias("d"))
             .agg(F.sum("quantity").cast("bigint").alias("sold")))


def ledger_partitions(n_pairs: int, n_days: int, rows_per_partition: int = ROWS_PER_PARTITION,
                      floor: int = 1) -> int:
    """Partitions sized for the exploded rows, never fewer than ``floor``."""
    return max(floor, math.ceil(n_pairs * n_days / rows_per_partition))


def pair_partitions(assortment: DataFrame, n_days: int, n_sales: int = 0) -> int:
    """Partitions for the pairs' days and for their events: the years, and at most ``n_sales`` sale days."""
    floor, n_pairs = int(assortment.sparkSession.conf.get("spark.sql.shuffle.partitions")), assortment.count()
    events = n_pairs * (n_days // 365 + 2) + n_sales
    return max(ledger_partitions(n_pairs, n_days, floor=floor), math.ceil(events / EVENTS_PER_PARTITION))


def stock_stretches(assortment: DataFrame, orders: DataFrame, start: str, end: str,
                    restock_every: int = RESTOCK_EVERY, partitions: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The ledger as stretches (:data:`STRETCH_COLUMNS`, ``year`` and ``keep``), dealt by the pair;
    none crosses a new year.  Days count from ``start``.

    ``assortment``: product_id, warehouse_id, initial_stock, restock_qty, and the columns ``keep``,
    which are the pair's.  They go with the pair's row through the one shuffle of the ledger.
    ``orders``: product_id, warehouse_id, order_date, quantity.  Sales of pairs
    that are not in the assortment are ignored.
    """
    n_days = _days_between(start, end)
    if partitions is None:
        assortment = assortment.checkpoint(eager=True)
        partitions = pair_partitions(assortment, n_days, orders.count())
    events = ledger_events(assortment, orders, start, start, end, restock_every, partitions, keep)
    ordered = Window.partitionBy(*PAIR).orderBy("year", "i")   # the order of the events as they come: one sort
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    restocked = F.col("rate") * _restock_days(F.col("i"), restock_every)
    x = F.max("initial_stock").over(whole) + F.sum(F.col("restock") - F.col("sold")).over(running) + restocked
    balance = (events.withColumn("x", x)
               .withColumn("next_i", F.coalesce(F.lead("i", 1).over(ordered), F.lit(n_days)))
               .where(F.col("x").isNotNull()))
    stock = F.col("x") - F.least(F.lit(0), F.min("x").over(running))
    return _as_stretches(balance.withColumn("stock_level", stock.cast("bigint")), restock_every, *keep)


def stock_ledger(assortment: DataFrame, orders: DataFrame, start: str, end: str,
                 restock_every: int = RESTOCK_EVERY, partitions: int | None = None) -> DataFrame:
    """Daily inventory snapshots in the raw inventory layout (``date`` is a
    typed date; :func:`stockflow.functions.calendar.iso_date` gives the text):
    the days of :func:`stock_stretches`."""
    return daily(stock_stretches(assortment, orders, start, end, restock_every, partitions), start, restock_every).select(*LEDGER_COLUMNS)


def _restock_days(i: Column, every: int) -> Column:
    """Restock days from day 0 to day ``i``."""
    return F.floor(i / every) + 1


def _as_stretches(events: DataFrame, every: int, *keep: str) -> DataFrame:
    """(pair, year, i, next_i, stock_level, restock, rate) and ``keep`` of settled events."""
    own = F.col("restock") + F.when(F.col("i") % every == 0, F.col("rate")).otherwise(0)
    return events.select(*PAIR, "i", "next_i", "stock_level", own.cast("bigint").alias("restock"), "rate", "year", *keep)


def daily(stretches: DataFrame, day0: str, restock_every: int = RESTOCK_EVERY) -> DataFrame:
    """Daily snapshots (:data:`LEDGER_COLUMNS`) of stretches, with their other columns."""
    more = [c for c in stretches.columns if c not in STRETCH_COLUMNS]
    days = stretches.select(*STRETCH_COLUMNS, *more, F.explode(F.sequence(F.col("i"), F.col("next_i") - 1)).alias("day"))
    d, zero = F.date_add(F.to_date(F.lit(day0)), F.col("day")), F.lit(0).cast("bigint")
    since = _restock_days(F.col("day"), restock_every) - _restock_days(F.col("i"), restock_every)
    return days.select(
        inventory_key("product_id", "warehouse_id", date_key(d)).alias("inventory_id"),
        d.alias("date"),
        "product_id", "warehouse_id",
        (F.col("stock_level") + F.col("rate") * since).alias("stock_level"),
        F.when(F.col("day") == F.col("i"), F.col("restock"))
         .when(F.col("day") % restock_every == 0, F.col("rate")).otherwise(zero).alias("restock_qty"),
        *more,
    )


# -- by periods ---------------------------------------------------------------------

def stocked_pairs(assortment: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A row a pair: repeated rows add up their restocks and keep the largest opening stock (and of ``keep``)."""
    return assortment.groupBy(*PAIR).agg(F.max(F.col("initial_stock").cast("bigint")).alias("initial_stock"),
                                         F.sum(F.col("restock_qty").cast("bigint")).alias("restock_qty"), *(F.max(c).alias(c) for c in keep))


def ledger_events(assortment: DataFrame, orders: DataFrame, day0: str, start: str, end: str,
                  restock_every: int = RESTOCK_EVERY, partitions: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(pair, year, i, restock, sold, rate, due, due_in_year, initial_stock) for the days
    from ``start`` to ``end``; i counts from ``day0``.  Every stocked pair has an event on
    the first day of each year, so that every year has its function (and ``initial_stock``
    there), and one on each day with sales.  ``rate`` is added on every restock day; ``due``
    counts those of the year up to the event.  A pair with a negative or unknown restock has
    rate 0 and events with their ``restock`` instead.  Columns ``keep`` of the assortment come with
    each event.  One row for each pair and sale day is dealt by the pair; a pair's further
    events are made where it is dealt to."""
    first, last = ((date.fromisoformat(d) - date.fromisoformat(day0)).days for d in (start, end))
    zero, none, origin = F.lit(0).cast("bigint"), F.lit(None).cast("bigint"), F.to_date(F.lit(day0))
    due = -(-first // restock_every) * restock_every
    opens = sorted({first} | {(date(y, 1, 1) - date.fromisoformat(day0)).days for y in range(date.fromisoformat(start).year + 1, date.fromisoformat(end).year + 1)})
    base, sales = stocked_pairs(assortment, keep), daily_units(orders, start, end)
    types = dict(base.dtypes)
    dealt = (base.select(*PAIR, F.lit(None).cast("int").alias("sale"), zero.alias("sold"), "restock_qty", "initial_stock", *keep)
             .unionByName(sales.select(*PAIR, F.datediff("d", origin).alias("sale"), F.col("sold").cast("bigint").alias("sold"), none.alias("restock_qty"),
                                       none.alias("initial_stock"), *(F.lit(None).cast(types[c]).alias(c) for c in keep))))
    if partitions:
        dealt = dealt.repartition(partitions, *PAIR)
    pair, grows = F.col("sale").isNull(), F.coalesce(F.col("restock_qty") >= 0, F.lit(False))
    event = lambda i, restock, rate, stock: F.struct(i.cast("int").alias("i"), restock.alias("restock"), rate.alias("rate"), stock.alias("initial_stock"))
    rate = F.when(grows, F.col("restock_qty")).otherwise(zero)
    made = F.array(*[event(F.lit(i), zero, rate, F.col("initial_stock")) for i in opens])
    if due <= last:
        restocks = F.transform(F.sequence(F.lit(due), F.lit(last), F.lit(restock_every)), lambda i: event(i, F.col("restock_qty"), zero, none))
        made = F.when(grows, made).otherwise(F.concat(made, restocks))
    events = (dealt.select(*PAIR, "sold", *keep, F.explode(F.when(pair, made).otherwise(F.array(event(F.col("sale"), zero, none, none)))).alias("e"))
              .select(*PAIR, "sold", *keep, "e.*"))
    year = F.year(F.date_add(origin, F.col("i")))
    pair_days = Window.partitionBy(*PAIR).orderBy("year", "i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = (events.groupBy(*PAIR, "i").agg(F.sum("restock").alias("restock"), F.sum("sold").alias("sold"), F.max("rate").alias("rate"),
                                             F.max("initial_stock").alias("initial_stock"), *(F.max(c).alias(c) for c in keep))
              .withColumn("year", year)
              .withColumns({c: F.max(c).over(pair_days) for c in ("rate", *keep)})
              .where("rate is not null"))   # others are not stocked
    new_year = lambda y: F.datediff(F.make_date(y, F.lit(1), F.lit(1)), origin)
    before = _restock_days(F.greatest(F.lit(first), new_year(F.col("year"))) - 1, restock_every)
    end_of_year = F.least(F.lit(last), new_year(F.col("year") + 1) - 1)
    return merged.select(*PAIR, "year", "i", "restock", "sold", "rate", (_restock_days(F.col("i"), restock_every) - before).alias("due"),
                         (_restock_days(end_of_year, restock_every) - before).alias("due_in_year"), "initial_stock", *keep)


def clamp_maps(events: DataFrame) -> DataFrame:
    """(pair, year, a, b): a year's stock as max(a, opening + b)."""
    upto = Window.partitionBy(*PAIR, "year").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    net = F.col("restock") - F.col("sold")
    x = events.select(*PAIR, "year", net.alias("net"), (F.col("rate") * F.col("due_in_year")).alias("in_year"),
                      (F.sum(net).over(upto) + F.col("rate") * F.col("due")).alias("x"))
    return (x.groupBy(*PAIR, "year").agg((F.sum("net") + F.max("in_year")).alias("b"), F.min("x").alias("low"))
            .select(*PAIR, "year", (F.col("b") - F.col("low")).alias("a"), "b"))


def opening_stock(maps: DataFrame, initial: DataFrame) -> DataFrame:
    """(pair, year, opening, closing) from the years' functions and each pair's
    ``initial_stock`` before the first of them; composed in order, a row a year."""
    w = Window.partitionBy(*PAIR).orderBy("year")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = maps.withColumn("bs", F.sum("b").over(upto))
    whole = total.withColumn("as", F.col("bs") + F.max(F.col("a") - F.col("bs")).over(upto))
    closed = whole.join(initial.select(*PAIR, F.col("initial_stock").cast("bigint").alias("s0")), PAIR)
    closing = F.greatest("as", F.col("s0") + F.col("bs"))
    return (closed.select(*PAIR, "year", "s0", closing.alias("closing"))
            .select(*PAIR, "year", F.coalesce(F.lag("closing").over(w), "s0").alias("opening"), "closing"))


def settled(events: DataFrame, openings: DataFrame, day0: str, end: str, restock_every: int = RESTOCK_EVERY) -> DataFrame:
    """Stretches of every (pair, year) from its opening stock.  A pair's openings meet its events
    as one row, by the pair alone, so events that are dealt by the pair are not dealt again."""
    ordered = Window.partitionBy(*PAIR, "year").orderBy("i")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    origin = F.to_date(F.lit(day0))
    after = F.least(F.datediff(F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)), origin),
                    F.datediff(F.to_date(F.lit(end)), origin) + 1)   # the day after the year's last
    by_pair = openings.groupBy(*PAIR).agg(F.map_from_entries(F.collect_list(F.struct("year", "opening"))).alias("openings"))
    x = (events.join(by_pair, PAIR).where(F.map_contains_key("openings", F.col("year")))
         .withColumn("opening", F.element_at("openings", F.col("year"))).drop("openings")
         .withColumn("x", F.col("opening") + F.sum(F.col("restock") - F.col("sold")).over(upto) + F.col("rate") * F.col("due"))
         .withColumn("next_i", F.coalesce(F.lead("i").over(ordered), after))
         .withColumn("stock_level", (F.col("x") - F.least(F.lit(0), F.min("x").over(upto))).cast("bigint")))
    return _as_stretches(x, restock_every)


def settle(events: DataFrame, openings: DataFrame, day0: str, end: str, restock_every: int = RESTOCK_EVERY) -> DataFrame:
    """Daily snapshots of every (pair, year) from its opening stock, in the ledger's layout."""
    return daily(settled(events, openings, day0, end, restock_every), day0, restock_every).select(*LEDGER_COLUMNS)


def _days_between(start: str, end: str) -> int:
    return (date.fromisoformat(end) - date.fromisoformat(start)).days + 1


def ledger_by_year(assortment: DataFrame, orders: DataFrame, start: str, end: str, restock_every: int = RESTOCK_EVERY,
                   snapshots: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(snapshots, closing): the whole ledger with each year settled on its own, and
    (pair, year, opening, closing).  ``snapshots`` makes something else than the daily rows
    of the settled stretches, such as sums of their days."""
    partitions = pair_partitions(assortment, _days_between(start, end), orders.count())
    events = ledger_events(assortment, orders, start, start, end, restock_every, partitions)
    openings = opening_stock(clamp_maps(events), stocked_pairs(assortment))
    return _snapshots(events, openings, start, end, restock_every, snapshots), openings


def _snapshots(events: DataFrame, openings: DataFrame, day0: str, end: str, restock_every: int,
               snapshots: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    if snapshots is None:
        return settle(events, openings, day0, end, restock_every)
    return snapshots(settled(events, openings, day0, end, restock_every))


def extend_ledger(closing: DataFrame, assortment: DataFrame, orders: DataFrame, day0: str, start: str, end: str,
                  restock_every: int = RESTOCK_EVERY, snapshots: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Snapshots and closing stock for the days from ``start`` to ``end``, going on
    from ``closing`` (pair, closing) of the day before; pairs that it does not know
    begin with their ``initial_stock``.  Of ``orders`` only these days are used."""
    partitions = pair_partitions(assortment, _days_between(start, end), orders.count())
    events = ledger_events(assortment, orders, day0, start, end, restock_every, partitions)
    known = closing.select(*PAIR, F.col("closing").cast("bigint").alias("closing"))
    initial = stocked_pairs(assortment).join(known, PAIR, "left").select(*PAIR, F.coalesce("closing", "initial_stock").alias("initial_stock"))
    openings = opening_stock(clamp_maps(events), initial)
    return _snapshots(events, openings, day0, end, restock_every, snapshots), openings


# -- surrogate ids ------------------------------------------------------------------

def pair_numbers(rows: DataFrame, out: str = "pair_number") -> DataFrame:
    """Adds the number 1, 2, 3 ... of every row's pair by product and warehouse."""
    pairs = global_rank(rows.select(*PAIR).distinct(), [(c, False) for c in PAIR], out)
    return rows.join(pairs, PAIR)


def snapshot_number(pair_number: str, day0: str, n_days: int) -> Column:
    day = F.datediff("date", F.to_date(F.lit(day0)))
    return snapshot_numbers(F.col(pair_number).cast("bigint"), day, n_days)


def snapshot_numbers(pair_number, day, n_days: int):
    """The number of the snapshot of a pair's day, on columns or arrays."""
    return (pair_number - 1) * n_days + day + 1


def surrogate_numbers(snapshots: DataFrame, day0: str, n_days: int, out: str = "number") -> DataFrame:
    """Adds the running number of every snapshot, 1, 2, 3 ... by product, warehouse and
    day, without ordering the snapshots: the number of the pair (ranked over the
    pairs only) is the leading digit, the day the last, in base ``n_days``.  Where
    snapshots come of stretches, :func:`pair_numbers` of the assortment and then
    :func:`snapshot_numbers` of their days give the same."""
    return pair_numbers(snapshots, "__pair").withColumn(out, snapshot_number("__pair", day0, n_days)).drop("__pair")


def padded_id(prefix: str, number: Column | str, width: int = 7) -> Column:
    """``INV0000042``: at least ``width`` digits, more if the number needs them."""
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), F.greatest(F.lit(width), F.length(number.cast("string"))), F.lit("0")))
