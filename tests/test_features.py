"""Demand features: row-based lags, full-window means, drop rule, fallbacks."""

from datetime import date, timedelta

from stockflow.operators import features as feat
from stockflow.operators import model as mdl

DAILY = ("full_date string, year int, month int, quarter int, week_number int, day_of_week int, "
         "is_weekend int, product_id string, category string, base_demand double, units_sold bigint")


def _daily(spark, histories):
    rows = []
    for pid, (cat, n) in histories.items():
        d0 = date(2024, 1, 1)
        for i in range(n):
            d = d0 + timedelta(days=2 * i)          # gaps: lags count selling days
            rows.append((d.isoformat(), d.year, d.month, (d.month - 1) // 3 + 1, int(d.strftime("%W")),
                         d.weekday(), int(d.weekday() >= 5), pid, cat, 10.0, i + 1))
    return spark.createDataFrame(rows, DAILY)


def test_short_histories_and_lags(spark):
    hist = {"P05": ("Cat0", 5), "P30": ("Cat0", 30), "P31": ("Cat1", 31), "P59": ("Cat1", 59), "P60": ("Cat2", 60)}
    daily = _daily(spark, hist)
    f = feat.demand_features(daily).collect()
    counts = {}
    for r in f:
        counts[r.product_id] = counts.get(r.product_id, 0) + 1
        # units_sold = position (1-based) in the product's own history
        assert r.lag_7 == r.units_sold - 7 and r.lag_30 == r.units_sold - 30
        assert r.rolling_7 == sum(range(r.units_sold - 7, r.units_sold)) / 7
        assert r.rolling_30 == sum(range(r.units_sold - 30, r.units_sold)) / 30
    assert counts == {"P31": 1, "P59": 29, "P60": 30}
    # encoders fitted before the drop: five products, three categories
    enc = {r.product_id: (r.product_enc, r.category_enc) for r in f}
    assert enc["P31"] == (2, 1) and enc["P60"] == (4, 2)


def test_forecast_fallbacks_and_new_product(spark):
    hist = {"P59": ("Cat1", 59), "P60": ("Cat2", 60)}
    daily = _daily(spark, hist)
    penc, cenc = feat.label_encoders(daily)
    f = feat.demand_features(daily, encoders=(penc, cenc))
    products = spark.createDataFrame([("P59", "n59", "Cat1", 10.0), ("P60", "n60", "Cat2", 10.0),
                                      ("NEW", "new", "CatZ", 7.0)],
                                     "product_id string, product_name string, category string, base_demand double")
    ff = {(r.product_id, r.forecast_date): r
          for r in mdl.forecast_features(f, products, penc, cenc, "2025-01-01", horizon=3).collect()}
    assert len(ff) == 9
    p60 = ff[("P60", "2025-01-02")]
    assert (p60.lag_7, p60.lag_14, p60.lag_30) == (54.0, 47.0, 31.0)
    assert p60.rolling_7 == sum(range(54, 61)) / 7 and p60.rolling_30 == sum(range(31, 61)) / 30
    p59 = ff[("P59", "2025-01-01")]   # 29 feature rows: every input falls back to base demand
    assert (p59.lag_7, p59.rolling_30, p59.product_enc) == (10.0, 10.0, 0)
    new = ff[("NEW", "2025-01-03")]   # unknown labels encode to 0
    assert (new.product_enc, new.category_enc, new.lag_14, new.week_number, new.day_of_week) == (0, 0, 7.0, 0, 4)


def test_time_split_disjoint_and_complete(spark):
    daily = _daily(spark, {"P60": ("Cat0", 60)})
    f = feat.demand_features(daily)
    train, test = feat.time_split(f, "full_date", "2024-04-01")
    assert train.count() + test.count() == f.count()
    assert train.agg({"full_date": "max"}).first()[0] < "2024-04-01" <= test.agg({"full_date": "min"}).first()[0]


def test_reorder_flag_uses_unrounded_prediction(spark):
    rows = spark.createDataFrame([("2025-01-01", "P", "n", "C", 10.0, 12.04), ("2025-01-02", "P", "n", "C", 10.0, 11.96),
                                  ("2025-02-01", "P", "n", "C", 10.0, -3.0)],
                                 "forecast_date string, product_id string, product_name string, category string, "
                                 "base_demand double, prediction double")
    out = mdl.forecast_rows(rows).collect()
    assert [(r.predicted_units, r.reorder_flag) for r in out] == [(12.0, 1), (12.0, 0), (0.0, 0)]
    monthly = {r.month: (r.predicted_units, r.reorder_days) for r in
               mdl.monthly_rollup(mdl.forecast_rows(rows), "forecast_date", "predicted_units", "reorder_flag",
                                  "predicted_units", "reorder_days").collect()}
    assert monthly == {"2025-01": (24.0, 1), "2025-02": (0.0, 0)}
