"""Driver contract and a small end-to-end run of the forest reports."""

import random

import duckdb
import pytest

from stockflow.operators import model as mdl
from stockflow.plans.forecast import DemandForecast
from stockflow.plans.warehouse import star_schema
from tests.conftest import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["year", "month", "month_name", "revenue", "total_orders", "units_sold",
                          "prev_month_revenue", "mom_pct_change"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def _oracle_keys():
    from stockflow.plans import catalog, oracle

    return sorted(k for k in catalog.QUERIES if k in oracle.oracle_sql())


@pytest.mark.parametrize("key", _oracle_keys())
def test_oracle_sf0001(spark, key):
    import __spark_entry__ as E

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF0001}/{t}.parquet')")
    df = E.queries()[key](spark, SF0001)
    names = sorted(df.columns)
    assert sorted(d[0] for d in con.execute(f"describe ({E.oracle_sql()[key]})").fetchall()) == names
    cur = con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in names)} from ({E.oracle_sql()[key]})")
    clean = lambda rows: sorted((tuple(None if v != v else round(v, 9) if isinstance(v, float) else v for v in r)
                                 for r in rows), key=lambda r: tuple((v is not None, v) for v in r))
    assert clean(df.select(*names).collect()) == clean(cur.fetchall())


def test_forest_reports(spark):
    fc = DemandForecast.of_brands(star_schema(spark, SF0001), num_trees=5, max_depth=5)
    imp = fc.feature_importance().collect()
    assert len(imp) == 13 and abs(sum(r.importance for r in imp) - 1) < 1e-9
    m = fc.model_metrics().first()
    assert m.train_rows + m.test_rows == fc.features().count() and m.n_features == 13
    fcst = fc.forecast()
    assert fcst.count() == fc.dim_products().count() * 90
    assert fcst.where("predicted_units < 0").count() == 0
    # 90 days after the last order span Nov, Dec, Jan and Feb
    assert fc.monthly().count() == fc.dim_products().count() * 4
    # the orders are read for the daily demand alone
    for frame in (fc.features_plan(), *fc.encoders()):
        assert not any("raw_orders" in f for f in frame.inputFiles())
    # the forest does better than the last week's mean
    assert m.mae < fc.naive_error().first().mae


def test_forest_does_not_depend_on_partitions(spark):
    train, test = DemandForecast.of_brands(star_schema(spark, SF0001)).split()
    scores = set()
    for n in (2, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            model = mdl.fit_forest(train.repartition(n), num_trees=4, max_depth=4)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        scores.add(mdl.error_metrics(mdl.predict(model, test)).first())
    assert len(scores) == 1


def test_one_split_is_the_best_one(spark):
    """A stump without sampling splits where the squared error is least."""
    rng = random.Random(4)
    rows = [(k, k % 10, (k * 7) % 4, 3.0 * (k % 10 >= 6) + rng.random()) for k in range(400)]
    df = spark.createDataFrame(rows, "id int, a int, b int, units_sold double")
    model = mdl.fit_forest(df, features=["a", "b"], num_trees=1, max_depth=1, min_leaf=1, keys=("id",), bootstrap=False)
    root = model.trees[0]._call_java("rootNode")
    split = root.split()
    con = duckdb.connect()
    con.register("t", df.toPandas())
    best = con.execute("""
        with cuts as (select 0 as f, unnest(range(0, 9)) as c union all select 1, unnest(range(0, 3))),
             sides as (select f, c, (case f when 0 then a else b end) <= c as lo, units_sold as y from t, cuts)
        select f, c from (select f, c, sum(n * v) as err from (select f, c, lo, count(*) as n, var_pop(y) as v from sides group by all)
                          group by all) order by err limit 1""").fetchall()[0]
    assert (split.featureIndex(), int(split.threshold())) == best
