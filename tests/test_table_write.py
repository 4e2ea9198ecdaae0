"""Tables written by folder: what a write task holds, and that every row arrives."""

import json
import subprocess
import sys

from pyspark.sql import functions as F

from stockflow.sources import files
from tests.conftest import ROOT


def test_partitioned_write_holds_no_rows(tmp_path):
    """Peak execution memory of the tasks of a write by folder, from Spark's event log."""
    (tmp_path / "events").mkdir()
    code = f"""
from pyspark.sql import SparkSession, functions as F
from stockflow.sources import files
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
     .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_path}/events")
     .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false").getOrCreate())
rows = s.range(0, 200_000, 1, 2).select("id", F.concat(F.lit("row "), "id").alias("text"), (F.col("id") % 7).alias("year"))
files.write_table(rows, "{tmp_path}/table", ["year"])
assert files.read_table(s, "{tmp_path}/table").groupBy("year").count().count() == 7
s.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, capture_output=True, timeout=120)
    (log,) = (tmp_path / "events").iterdir()
    events = [json.loads(line) for line in log.read_text().splitlines()]
    wrote = [e["Task Metrics"]["Peak Execution Memory"] for e in events
             if e["Event"] == "SparkListenerTaskEnd" and e["Task Metrics"]["Output Metrics"]["Records Written"]]
    assert len(wrote) == 2 and max(wrote) < 1_000_000


def test_more_folders_than_open_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    n = 2 * files.OPEN_FOLDERS + 1
    rows = spark.range(0, 1000, 1, 2).withColumn("year", F.when(F.col("id") % n > 0, F.col("id") % n))
    files.write_table(rows, str(tmp_path / "t"), ["year"])
    assert sorted(map(tuple, files.read_table(spark, str(tmp_path / "t")).collect())) == sorted(map(tuple, rows.collect()))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
