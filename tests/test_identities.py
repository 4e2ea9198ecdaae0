"""Cross-query identities on the sf0.001 test tables (as in the reference's
published outputs: the same revenue total in KPI 1, 3, 6, 8; the same order
count in KPI 1, 2, 3; KPI 7's units equal KPI 4's)."""

from datetime import date

import pytest

from tests.conftest import SF0001


@pytest.fixture(scope="module")
def q(spark):
    import __spark_entry__ as E

    qs = E.queries()
    return lambda key: qs[key](spark, SF0001).collect()


def test_revenue_and_order_totals_agree(q):
    cards = q("dash_revenue_cards")[0]
    k1 = q("kpi1_monthly_revenue")
    assert round(sum(r.revenue for r in k1), 2) == pytest.approx(cards.total_revenue, abs=0.01 * len(k1))
    for key, col in [("kpi3_supplier_scorecard", "total_revenue_supplied"), ("kpi6_category_quarterly", "total_revenue"),
                     ("kpi8_warehouse_performance", "total_revenue"), ("v2_revenue_by_year", "total_revenue")]:
        rows = q(key)
        assert sum(getattr(r, col) for r in rows) == pytest.approx(cards.total_revenue, abs=0.01 * len(rows))
    n = cards.total_orders
    assert sum(r.total_orders for r in k1) == n
    assert sum(r.total_orders for r in q("kpi2_delivery_rate")) == n
    assert sum(r.total_orders for r in q("kpi3_supplier_scorecard")) == n


def test_quarters_add_up(q):
    for r in q("kpi6_category_quarterly"):
        assert r.q1_revenue + r.q2_revenue + r.q3_revenue + r.q4_revenue == pytest.approx(r.total_revenue, abs=0.03)


def test_status_counts_add_up(q):
    for r in q("kpi2_delivery_rate"):
        assert r.delivered + r.delayed + r.cancelled == r.total_orders
        assert r.on_time_rate_pct == round(100 * r.delivered / r.total_orders + 1e-9, 1)


def test_top_products_units_match_turnover(q):
    # product names repeat in the test data, so match on the whole description
    turnover = {(r.product_name, r.category, r.supplier_name, r.units_sold) for r in q("kpi4_inventory_turnover")}
    top = q("kpi7_top_products")
    assert len(top) == 10
    for r in top:
        assert (r.product_name, r.category, r.supplier_name, r.units_sold) in turnover


def test_row_counts_and_ledger(q):
    counts = {r.table: r.n for r in q("v1_row_counts")}
    load = q("load_summary")[0]
    assert counts["fact_orders"] == load.order_rows
    assert counts["fact_inventory"] == load.inventory_rows
    days = q("dim_date")
    first, last = min(r.full_date for r in days), max(r.full_date for r in days)
    n_days = (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
    assert counts["dim_date"] == len(days) == n_days
    assert load.inventory_rows % n_days == 0     # every stocked pair has a snapshot on every day of the orders


def test_ledger_reads_every_order(spark):
    """Units that reach the ledger are all units ordered, on every day there is."""
    from pyspark.sql import functions as F

    from stockflow.operators.ledger import daily_units
    from stockflow.plans.warehouse import star_schema

    ws = star_schema(spark, SF0001)
    first, last = (d.isoformat() for d in ws.order_days())
    orders = ws.raw("orders")
    pairs = ws.source.assortment(orders).select("product_id", "warehouse_id")
    into = daily_units(orders, first, last).join(pairs, ["product_id", "warehouse_id"]).agg(F.sum("sold")).first()[0]
    assert into == orders.agg(F.sum("quantity")).first()[0]
    assert ws.plan("dim_date").agg(F.min("full_date"), F.max("full_date")).first() == (first, last)
