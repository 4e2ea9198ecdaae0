"""The ledger split in time, running numbers, versioned tables, rejects, pruned folders."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stockflow.operators import ledger
from stockflow.plans import catalog, kpis
from stockflow.plans.warehouse import YEAR, star_schema
from stockflow.sources import files
from tests.conftest import SF0001

START, END = "2019-11-20", "2022-02-10"


@pytest.fixture(scope="module")
def stock(spark):
    rng = random.Random(4)
    assortment = spark.createDataFrame([(p, w, rng.randrange(30), rng.randrange(4)) for p in range(6) for w in range(2)],
                                       "product_id long, warehouse_id long, initial_stock long, restock_qty long")
    days = [str(r[0]) for r in spark.sql(f"select explode(sequence(date'{START}', date'{END}', interval 1 day))").collect()]
    orders = spark.createDataFrame([(rng.randrange(7), rng.randrange(2), rng.choice(days), rng.randrange(1, 5)) for _ in range(900)],
                                   "product_id long, warehouse_id long, order_date string, quantity long")
    return assortment.checkpoint(eager=True), orders.checkpoint(eager=True)


def table(df):
    return sorted(map(tuple, df.select(*ledger.LEDGER_COLUMNS).collect()))


def test_years_apart_equal_the_whole(stock):
    assortment, orders = stock
    whole = table(ledger.stock_ledger(assortment, orders, START, END))
    apart, _ = ledger.ledger_by_year(assortment, orders, START, END)
    assert table(apart) == whole


def test_goes_on_from_the_closing_stock(stock):
    assortment, orders = stock
    whole = table(ledger.stock_ledger(assortment, orders, START, END))
    one, openings = ledger.ledger_by_year(assortment, orders.where("order_date < '2020-01-01'"), START, "2019-12-31")
    rows, closing = table(one), openings
    for year, end in ((2020, "2020-12-31"), (2021, "2021-12-31"), (2022, END)):
        only = orders.where(F.year(F.to_date("order_date")) == year)   # no older order is there
        more, openings = ledger.extend_ledger(closing, assortment, only, START, f"{year}-01-01", end)
        rows += table(more)
        closing = openings.checkpoint(eager=True)
    assert sorted(rows) == whole


def test_functions_compose(stock):
    assortment, orders = stock
    maps = ledger.clamp_maps(ledger.ledger_events(assortment, orders, START, START, END)).collect()
    got = {(r["product_id"], r["warehouse_id"], r["year"]): r["closing"] for r in ledger.opening_stock(
        ledger.clamp_maps(ledger.ledger_events(assortment, orders, START, START, END)), assortment).collect()}
    initial = {tuple(r)[:2]: r["initial_stock"] for r in assortment.collect()}
    for pair in initial:
        s = initial[pair]
        for m in sorted((m for m in maps if tuple(m)[:2] == pair), key=lambda m: m["year"]):
            s = max(m["a"], s + m["b"])
            assert got[(*pair, m["year"])] == s


def test_an_added_year_reads_its_folder_only(spark):
    ws = star_schema(spark, SF0001)
    last = ws.order_days()[1].year
    orders = ws.by_year("raw_orders").where(F.col(YEAR) == last)
    assert {f.split(f"{YEAR}=")[1][:4] for f in orders.inputFiles()} >= {str(last)}
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({YEAR}" in plan and f"= {last})" in plan


def test_numbers_are_dense_in_order(spark, stock):
    assortment, orders = stock
    snapshots = ledger.stock_ledger(assortment, orders, START, END)
    n_days = snapshots.select("date").distinct().count()
    numbered = ledger.surrogate_numbers(snapshots, START, n_days).withColumn("id", ledger.padded_id("INV", "number"))
    rows = sorted(numbered.select("product_id", "warehouse_id", "date", "number", "id").collect())
    assert [r["number"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows[41]["id"] == "INV0000042"
    assert spark.range(1).select(ledger.padded_id("INV", F.lit(123456789))).first()[0] == "INV123456789"


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(5), path)
    bad = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("dies"))).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="dies"):
        files.write_table(bad, path)
    assert files.read_table(spark, path).count() == 5
    reader = files.read_table(spark, path)
    files.write_table(spark.range(7).withColumn("k", F.col("id") % 2), path, ["k"])
    assert files.read_table(spark, path).count() == 7 and reader.count() == 5   # who reads the last version still can
    files.write_table(spark.range(8), path)
    kept = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]
    assert files.read_table(spark, path).count() == 8 and len(kept) == 2


def test_rows_and_rejects_are_all_lines(spark, tmp_path):
    folder = tmp_path / "suppliers.csv"
    folder.mkdir()
    head = "supplier_id,supplier_name,country,contact_email,on_time_rate,avg_lead_time_days,remark\n"
    (folder / "a.csv").write_text(head + 'S1,"Ann, Co",US,a@x.org,0.9,7,\nS2,B,US,,oops,7,\nS3,C\nS4,D,US,,,,fine\n')
    (folder / "b.csv").write_text(head + "S5,E,US,,0.5,x,\nS6,F,US,,0.5,3,,,\nS7,G,US,,0.5,3,\n")
    rows, rejects = files.read_checked(spark, str(folder), "suppliers")
    assert sorted(r["supplier_id"] for r in rows.collect()) == ["S1", "S4", "S7"] and rows.count() + rejects.count() == 7
    found = {(r["line"].split(",")[0], r["file"].rsplit("/", 1)[1]): r["reason"] for r in rejects.collect()}
    assert found == {("S2", "a.csv"): "on_time_rate is no double", ("S3", "a.csv"): "number of fields", ("S5", "b.csv"): "avg_lead_time_days is no int",
                     ("S6", "b.csv"): "number of fields"}
    assert [c for c, _ in rows.dtypes] == [f.name for f in files.RAW_SCHEMAS["suppliers"].fields]


def test_calendar_filters_prune_folders(spark):
    ws = star_schema(spark, SF0001)
    dd = ws.table("dim_date")
    year = ws.order_days()[1].year
    days = dd.where((F.col("full_date") >= f"{year}-01-01") & (F.col("is_weekend") == 1))   # says nothing about the year
    some = kpis.within(ws.by_year("fact_orders"), days)
    assert "dynamicpruningexpression" in some._jdf.queryExecution().executedPlan().toString()
    some.collect()
    scan = next(line for line in some._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line and "revenue" in line)
    assert "dynamicpruningexpression(true)" not in scan
    want = ws.table("fact_orders").join(days.select("date_id"), "date_id", "left_semi").select(*some.columns)
    assert some.columns == ws.table("fact_orders").columns and some.exceptAll(want).isEmpty() and want.exceptAll(some).isEmpty()


def test_stretches_are_few_and_hold_every_day(spark):
    """Rows kept follow the sales, not the days; a falling or unknown restock is settled day by day."""
    assortment = spark.createDataFrame([("A", "W", 5, 3), ("B", "W", 9, -4), ("C", "W", 7, 0), ("C", "W", 2, 2), ("D", None, 1, 1)],
                                       "product_id string, warehouse_id string, initial_stock long, restock_qty long")
    sales = [("A", "W", "2020-01-01", 50), ("A", "W", "2020-03-01", 2), ("A", "W", "2021-01-01", 9), ("C", "W", "2020-01-15", 20),
             ("D", None, "2020-02-02", 3), ("E", "W", "2020-02-02", 3)]
    orders = spark.createDataFrame(sales, "product_id string, warehouse_id string, order_date string, quantity long")
    first, last = date(2019, 12, 30), date(2021, 2, 3)
    stretches = ledger.stock_stretches(assortment, orders, str(first), str(last), partitions=3)
    assert stretches.where("product_id <> 'B'").count() == 3 * 3 + 3   # a year each, and the sales on other days than New Year's
    got = {(r["product_id"], r["date"]): (r["stock_level"], r["restock_qty"], r["warehouse_id"])
           for r in ledger.stock_ledger(assortment, orders, str(first), str(last), partitions=3).collect()}
    want = {}
    for product, house, stock, restock in (("A", "W", 5, 3), ("B", "W", 9, -4), ("C", "W", 7, 2), ("D", None, 1, 1)):
        for i in range((last - first).days + 1):
            day = first + timedelta(days=i)
            more = restock if i % 14 == 0 else 0
            stock = max(0, stock + more - sum(q for p, w, d, q in sales if (p, w, d) == (product, house, str(day))))
            want[product, day] = (stock, more, house)
    assert got == want


def test_the_stored_ledger_has_no_row_a_day(spark):
    ws = star_schema(spark, SF0001)
    days, kept = ws.table("fact_inventory").count(), ws.stretches().count()
    assert days == ws.assortment().count() * ws.horizon_days and kept * 50 < days


def test_csv_slices_hold_all_days_and_are_deleted(spark, monkeypatch):
    ws = star_schema(spark, SF0001)
    monkeypatch.setattr(catalog, "CSV_ROWS", ws.assortment().count() * ws.horizon_days // 3)
    gone = []
    monkeypatch.setattr(files, "delete", lambda s, path, real=files.delete: (real(s, path), gone.append(path)))
    rows = catalog.q_csv_inventory(spark, SF0001).agg(F.sum("n_days"), F.count("product_id")).first()
    assert tuple(rows) == (ws.assortment().count() * ws.horizon_days, ws.assortment().count())
    assert len(gone) >= 3 and not any(files._file_system(spark, p)[2].exists(files._file_system(spark, p)[1]) for p in gone)
