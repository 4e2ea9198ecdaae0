"""KPI edge cases on hand-made star-schema tables."""

from decimal import Decimal

from stockflow.operators.dims import date_dimension
from stockflow.plans import kpis

FO = ("order_id string, date_id int, product_id string, warehouse_id string, quantity bigint, "
      "unit_price decimal(18,2), total_amount decimal(18,2), revenue decimal(18,2), shipping_method string, "
      "status string, customer_city string, customer_state string")
PROD = ("product_id string, product_name string, category string, supplier_id string, unit_cost decimal(18,2), "
        "unit_price decimal(18,2), base_demand int, margin_pct double")
SUP = "supplier_id string, supplier_name string, country string, on_time_rate double, avg_lead_time_days int"
WH = "warehouse_id string, warehouse_name string, city string, state string, capacity int"
INV = ("inventory_id string, date_id int, product_id string, warehouse_id string, stock_level bigint, "
       "restock_qty bigint, days_of_supply double, stockout_flag int")


def _order(i, pid, qty, amount, status, date_id=20240115, wid="W1"):
    a = Decimal(amount)
    rev = Decimal("0.00") if status == "Cancelled" else a
    return (f"O{i}", date_id, pid, wid, qty, a, a, rev, "Standard", status, "c", "s")


def _products(spark, ids, supplier="S1", category="C"):
    return spark.createDataFrame([(p, f"name-{p}", category, supplier, Decimal("1.00"), Decimal("2.00"), 5, 50.0)
                                  for p in ids], PROD)


def test_turnover_edges(spark):
    fo = spark.createDataFrame([_order(1, "A", 20, "1.00", "Delivered"), _order(2, "B", 40, "1.00", "Delivered"),
                                _order(3, "B", 99, "1.00", "Cancelled"), _order(4, "C", 5, "1.00", "Delivered"),
                                _order(5, "D", 7, "1.00", "Delivered")], FO)
    inv = spark.createDataFrame([("i1", 20240101, "A", "W1", 10, 0, 1.0, 0), ("i2", 20240101, "B", "W1", 10, 0, 1.0, 0),
                                 ("i3", 20240101, "C", "W1", 0, 0, 0.0, 1), ("i4", 20240101, "E", "W1", 3, 0, 1.0, 0)],
                                INV)
    sup = spark.createDataFrame([("S1", "Sup", "X", 0.9, 5)], SUP)
    out = {r.product_name: r for r in kpis.inventory_turnover(fo, inv, _products(spark, "ABCDE"), sup).collect()}
    assert (out["name-A"].inventory_turnover, out["name-A"].stock_status) == (2.0, "Monitor")
    assert (out["name-B"].units_sold, out["name-B"].stock_status) == (40, "Healthy")
    assert (out["name-C"].avg_stock, out["name-C"].inventory_turnover, out["name-C"].stock_status) == \
        (0.0, None, "Overstocked")
    assert (out["name-D"].avg_stock, out["name-D"].inventory_turnover, out["name-D"].stock_status) == \
        (0.0, None, "Overstocked")
    assert (out["name-E"].units_sold, out["name-E"].inventory_turnover) == (0, 0.0)


def test_supplier_rank_ties(spark):
    rows, i = [], 0
    for sup, delayed, total in [("S1", 1, 10), ("S2", 2, 20), ("S3", 3, 10), ("S4", 0, 5)]:
        for k in range(total):
            i += 1
            rows.append(_order(i, f"P{sup}", 1, "2.00", "Delayed" if k < delayed else "Delivered"))
    fo = spark.createDataFrame(rows, FO)
    prods = spark.createDataFrame([(f"P{s}", "n", "C", s, Decimal("1.00"), Decimal("2.00"), 5, 50.0)
                                   for s in ("S1", "S2", "S3", "S4")], PROD)
    sup = spark.createDataFrame([(s, f"name-{s}", "X", 0.9, 5) for s in ("S1", "S2", "S3", "S4")], SUP)
    got = {r.supplier_id: (r.delay_rank, r.actual_delay_rate_pct, r.total_orders)
           for r in kpis.supplier_scorecard(fo, prods, sup).collect()}
    assert got == {"S3": (1, 30.0, 10), "S1": (2, 10.0, 10), "S2": (2, 10.0, 20), "S4": (4, 0.0, 5)}


def test_top_products_tie_at_cut(spark):
    rows = [_order(i, f"P{i:02d}", 1, f"{100 - i}.00", "Delivered") for i in range(1, 10)]
    rows += [_order(10, "P10", 1, "50.00", "Delivered"), _order(11, "P11", 1, "50.00", "Delivered"),
             _order(12, "P01", 1, "500.00", "Cancelled")]
    fo = spark.createDataFrame(rows, FO)
    prods = _products(spark, [f"P{i:02d}" for i in range(1, 12)])
    sup = spark.createDataFrame([("S1", "Sup", "X", 0.9, 5)], SUP)
    out = kpis.top_products(fo, prods, sup, top=10).collect()
    assert len(out) == 10
    assert [r.revenue_rank for r in out] == list(range(1, 11))
    assert out[-1].product_name == "name-P10"   # tie broken by product id
    assert out[0].total_revenue == 99.0          # cancelled order excluded


def test_missing_quarter_is_zero(spark):
    dd = date_dimension(spark, "2024-01-01", "2024-12-31")
    fo = spark.createDataFrame([_order(1, "A", 1, "10.00", "Delivered", 20240110),
                                _order(2, "A", 1, "5.00", "Delivered", 20241110),
                                _order(3, "A", 1, "7.00", "Cancelled", 20240810)], FO)
    r = kpis.category_quarterly(fo, _products(spark, "A"), dd).collect()[0]
    assert (r.q1_revenue, r.q2_revenue, r.q3_revenue, r.q4_revenue, r.total_revenue) == (10.0, 0.0, 0.0, 5.0, 15.0)


def test_stockouts_top_cut_is_deterministic(spark):
    inv = [(f"i{p}{d}", 20240101 + d, p, "W1", 0, 0, None, 1) for p in "ABC" for d in range(3)]
    inv += [("x", 20240101, "D", "W1", 5, 0, 1.0, 0)]
    fi = spark.createDataFrame(inv, INV)
    wh = spark.createDataFrame([("W1", "W one", "City", "ST", 100)], WH)
    out = kpis.stockouts(fi, _products(spark, "ABCD"), wh, horizon_days=730, top=2).collect()
    assert [(r.product_name, r.total_stockout_days, r.pct_days_out_of_stock) for r in out] == \
        [("name-A", 3, 0.4), ("name-B", 3, 0.4)]
