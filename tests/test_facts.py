"""Load-time business rules: revenue by status, demand, days of supply."""

from decimal import Decimal

from stockflow.operators import dims, facts


def _orders(spark, rows):
    return spark.createDataFrame(
        rows, "order_id string, order_date string, product_id string, warehouse_id string, "
              "customer_city string, customer_state string, quantity bigint, unit_price decimal(18,2), "
              "total_amount decimal(18,2), shipping_method string, status string")


def test_revenue_rule_null_status(spark):
    o = _orders(spark, [
        ("O1", "2024-01-05", "P1", "W1", "c", "s", 2, Decimal("5.00"), Decimal("10.00"), "Express", "Delivered"),
        ("O2", "2024-01-06", "P1", "W1", "c", "s", 1, Decimal("5.00"), Decimal("5.00"), "Express", "Cancelled"),
        ("O3", "2024-01-07", "P1", "W1", "c", "s", 3, Decimal("5.00"), Decimal("15.00"), "Express", None),
    ])
    got = {r.order_id: (r.date_id, r.revenue) for r in facts.fact_orders(o).collect()}
    assert got["O1"] == (20240105, Decimal("10.00"))
    assert got["O2"] == (20240106, Decimal("0.00"))
    # a NULL status is not cancelled: it keeps its amount
    assert got["O3"] == (20240107, Decimal("15.00"))


def test_days_of_supply_edges(spark):
    # P1 never ordered (demand 1), P2 ordered 0 units (demand 0), P3 73 units / 730 = 0.1
    o = _orders(spark, [
        ("O1", "2024-01-05", "P2", "W1", "c", "s", 0, Decimal("5.00"), Decimal("0.00"), "Express", "Delivered"),
        ("O2", "2024-01-05", "P3", "W1", "c", "s", 73, Decimal("5.00"), Decimal("365.00"), "Express", "Delivered"),
    ])
    inv = spark.createDataFrame([
        ("I1", "2024-01-05", "P1", "W1", 0, 0), ("I2", "2024-01-05", "P1", "W1", 50, 0),
        ("I3", "2024-01-05", "P2", "W1", 0, 0), ("I4", "2024-01-05", "P2", "W1", 10, 0),
        ("I5", "2024-01-05", "P3", "W1", 25, 0), ("I6", "2024-01-05", "P3", "W1", 100000, 0),
    ], "inventory_id string, date string, product_id string, warehouse_id string, stock_level bigint, "
       "restock_qty bigint")
    fi = facts.fact_inventory(inv, facts.avg_daily_demand(o, 730))
    got = {r.inventory_id: (r.days_of_supply, r.stockout_flag) for r in fi.collect()}
    assert got["I1"] == (0.0, 1) and got["I2"] == (50.0, 0)          # demand defaults to 1
    assert got["I3"] == (None, 1) and got["I4"] == (999.0, 0)        # 0/0 -> NULL, x/0 -> cap
    assert got["I5"] == (250.0, 0) and got["I6"] == (999.0, 0)       # capped at 999


def test_margin_half_even(spark):
    p = spark.createDataFrame([("P1", "n", "c", "S1", Decimal("6.00"), Decimal("8.00"), 5),
                               ("P2", "n", "c", "S1", Decimal("1.00"), Decimal("0.00"), 5)],
                              "product_id string, product_name string, category string, supplier_id string, "
                              "unit_cost decimal(18,2), unit_price decimal(18,2), base_demand int")
    got = {r.product_id: r.margin_pct for r in dims.product_dimension(p).collect()}
    assert got == {"P1": 25.0, "P2": None}
