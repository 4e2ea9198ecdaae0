"""Real inputs and outputs: CSV columns by name, a warehouse from five CSV files
with its exported reports, and the shared folder."""

import os

import pytest

from stockflow import session
from stockflow.operators import dims
from stockflow.plans import export
from stockflow.plans.forecast import DemandForecast
from stockflow.plans.warehouse import TABLES, StarSchema, star_schema
from stockflow.sources import files
from tests.conftest import SF0001


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_columns_are_bound_by_name(spark, tmp_path):
    header = "city,warehouse_id,extra,warehouse_name,capacity,state"
    p = _write(tmp_path / "w.csv", header + "\nBern,W1,x,Main,10,BE\n")
    row = files.read_raw(spark, p, "warehouses").first()
    assert row.asDict() == {"warehouse_id": "W1", "warehouse_name": "Main", "city": "Bern", "state": "BE", "capacity": 10}
    with pytest.raises(ValueError, match="capacity"):
        files.read_raw(spark, _write(tmp_path / "m.csv", "warehouse_id,warehouse_name,city,state\nW1,M,B,BE\n"), "warehouses")


def test_dimensions_need_their_columns(spark):
    full = spark.createDataFrame([("S", "n", "c", "m@x", 0.5, 3, "more")],
                                 "supplier_id string, supplier_name string, country string, contact_email string, "
                                 "on_time_rate double, avg_lead_time_days int, note string")
    assert dims.supplier_dimension(full).columns == [*dims.SUPPLIER_COLUMNS, "note"]
    with pytest.raises(Exception, match="contact_email"):
        dims.supplier_dimension(full.drop("contact_email")).count()


def test_warehouse_from_csv_and_exports(spark, tmp_path):
    made = star_schema(spark, SF0001)
    for name in ("suppliers", "products", "warehouses", "orders", "inventory"):
        files.write_csv(made.raw(name), f"{tmp_path}/in/{name}.csv")
    ws = StarSchema(spark, files.CsvFolder(spark, f"{tmp_path}/in"))
    for name in TABLES:
        assert ws.table(name).count() == made.table(name).count(), name
    export.write_kpis(ws, f"{tmp_path}/out")
    for (name, mine), theirs in zip(export.kpi_frames(ws).items(), export.kpi_frames(made).values(), strict=True):
        drop = [c for c in mine.columns if c in ("supplier_id",)]
        key = lambda r: tuple(map(str, r))
        assert sorted(mine.drop(*drop).collect(), key=key) == sorted(theirs.drop(*drop).collect(), key=key), name
        assert spark.read.option("header", True).csv(f"{tmp_path}/out/{name}.csv").count() == mine.count()
    fc = DemandForecast.from_schema(ws, cutoff="2001-01-01", num_trees=2, max_depth=3)
    assert fc.daily().count() > 0 and fc.start == made.day_after()


def test_tables_are_partitioned_by_year(spark):
    files_ = star_schema(spark, SF0001).table("fact_orders").inputFiles()
    assert files_ and all("__year=" in f for f in files_)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(session.NoSharedFolder):
        session.ensure_checkpoint_dir(Session())


def test_the_package_stands_without_llm(spark):
    """Nothing outside the subpackage imports it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(os.path.join(root, "stockflow")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    text = open(os.path.join(folder, n)).read()
                    assert "stockflow.llm" not in text and "corpus_pipeline" not in text, n
