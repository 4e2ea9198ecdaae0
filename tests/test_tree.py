"""Trees as tables against brute force and Spark ML."""

import pytest
from pyspark.sql import functions as F

from stockflow.operators import features, model, tree

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select(F.col("id").alias("key"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 7 % 23).cast("double").alias("b"),
                                 F.lit(1.0).alias("c"))
    y = F.when(F.col("a") > 9, 40).otherwise(10) + F.when(F.col("b") <= 5, 7).otherwise(0) + F.col("key") % 3
    return df.withColumn("units_sold", y.cast("bigint")).checkpoint(eager=True)


def brute(rows, depth, min_leaf, node=1):
    """Node -> (feature, threshold, n, mean) with every value its own cut."""
    ys = [r["units_sold"] for r in rows]
    out = {node: (-1, None, len(rows), sum(ys) / len(ys))}
    if not depth:
        return out
    best = None
    for f, name in enumerate(COLUMNS):
        for cut in sorted({r[name] for r in rows}):
            left = [r["units_sold"] for r in rows if r[name] <= cut]
            right = [r["units_sold"] for r in rows if r[name] > cut]
            if min(len(left), len(right)) < min_leaf:
                continue
            fall = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - sum(ys) ** 2 / len(ys)
            if fall > 1e-9 and (best is None or fall > best[0] + 1e-9):
                best = (fall, f, cut)
    if best:
        _, f, cut = best
        out[node] = (f, cut, len(rows), out[node][3])
        out |= brute([r for r in rows if r[COLUMNS[f]] <= cut], depth - 1, min_leaf, 2 * node)
        out |= brute([r for r in rows if r[COLUMNS[f]] > cut], depth - 1, min_leaf, 2 * node + 1)
    return out


def test_tree_equals_the_exhaustive_search(rows):
    want = brute(rows.collect(), 3, 5)
    got = tree.grow_tree(rows, COLUMNS, depth=3, bins=64, min_leaf=5).collect()   # 64 bins part all values
    assert {r["node"]: (r["feature"], r["threshold"], int(r["weight"])) for r in got} == {k: v[:3] for k, v in want.items()}
    for r in got:
        assert r["prediction"] == pytest.approx(want[r["node"]][3])


def test_tree_does_not_depend_on_partitions(rows):
    one, many = (sorted(map(tuple, tree.grow_tree(rows.repartition(n), COLUMNS).collect()), key=str) for n in (1, 13))
    assert one == many


def test_scores_follow_the_nodes(rows):
    nodes = tree.grow_tree(rows, COLUMNS).checkpoint(eager=True)
    table = {r["node"]: r for r in nodes.collect()}
    got = {r["key"]: r["prediction"] for r in tree.score(rows, nodes, ["key"], tree.TREE_DEPTH, COLUMNS).collect()}
    for r in rows.collect():
        k = 1
        while table[k]["feature"] >= 0:
            k = 2 * k + (r[COLUMNS[table[k]["feature"]]] > table[k]["threshold"])
        assert got[r["key"]] == table[k]["prediction"]


def test_degenerate_inputs(rows):
    same = rows.withColumn("units_sold", F.lit(3).cast("bigint"))
    (only,) = tree.grow_tree(same, COLUMNS).collect()
    assert only["feature"] == tree.LEAF and only["prediction"] == 3.0
    assert {r["importance"] for r in tree.importance(tree.grow_tree(same, COLUMNS), COLUMNS).collect()} == {0.0}
    assert tree.grow_tree(rows.limit(0), COLUMNS).count() == 0


def test_forest_from_its_files_without_a_refit(spark, rows, tmp_path):
    fitted = model.fit_forest(rows, COLUMNS, num_trees=7, max_depth=6, keys=("key",))
    path = str(tmp_path / "forest")
    fitted.write().save(path)
    nodes = tree.forest_nodes(spark, path)   # nothing but the stored rows from here on
    got = {r["key"]: r["prediction"] for r in tree.score(rows, nodes, ["key"], 6, COLUMNS).collect()}
    for r in model.predict(fitted, rows, COLUMNS).collect():
        assert got[r["key"]] == pytest.approx(r["prediction"], abs=1e-12)
    own = {r["feature"]: r["importance"] for r in tree.importance(nodes, COLUMNS).collect()}
    assert [own[c] for c in COLUMNS] == pytest.approx(list(fitted.featureImportances.toArray()), abs=1e-12)
    assert "PythonUDF" not in tree.score(rows, nodes, ["key"], 6, COLUMNS)._jdf.queryExecution().toString()


def test_a_forecast_scores_from_a_stored_forest(spark, tmp_path, monkeypatch):
    from stockflow.plans.forecast import DemandForecast
    from stockflow.plans.warehouse import star_schema
    from tests.conftest import SF0001

    first = DemandForecast.of_brands(star_schema(spark, SF0001), num_trees=3, max_depth=4)
    want = {tuple(r)[:4]: r["predicted_units"] for r in first.forecast().collect()}
    path = first.save_forest(str(tmp_path / "forest"))
    monkeypatch.setattr(model, "fit_forest", lambda *a, **k: pytest.fail("fitted again"))
    later = DemandForecast.of_brands(star_schema(spark, SF0001), num_trees=3, max_depth=4, forest_path=path)
    got = {tuple(r)[:4]: r["predicted_units"] for r in later.node_forecast(later.forest_nodes(), later.forest_depth()).collect()}
    assert got == want


@pytest.mark.parametrize("counts, percent, want", [([1, 1, 1, 1], 50, "d2"), ([98, 1, 1], 84, "d1"), ([1, 1, 98], 84, "d2"), ([5], 84, "d0"), ([], 84, None)])
def test_cutoff_by_share(spark, counts, percent, want):
    days = [(f"d{k}",) for k, n in enumerate(counts) for _ in range(n)] + [(None,)]
    assert features.share_cutoff(spark.createDataFrame(days, "full_date string"), "full_date", percent) == want
