"""Session construction and the shared working folder.

Cluster jobs take their settings from the submitting environment; the
builder here is for tests, the benchmark and local runs only.  It never
overrides ``spark.checkpoint.dir`` when the cluster already names one.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(cores: int | None = None, shuffle_partitions: int | None = None,
                app_name: str = "stockflow") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STOCKFLOW_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """Raised on a cluster that names no shared working folder."""


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named in ``spark.checkpoint.dir``.

    Only a local master (tests, bench: driver and executors are one process)
    gets a private folder when none is configured.  On any other master a
    machine-local folder would be invisible to the executors, so the job stops.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not re.match(r"local(\[[^,\]]*(,\s*\d+)?\])?$", master):
            raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that the driver and all executors share "
                                 f"(master is {master})")
        configured = tempfile.mkdtemp(prefix="stockflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that code
    in Python workers imports it wherever the workers start."""
    sc = spark.sparkContext
    if getattr(sc, "_stockflow_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="stockflow-zip-")   # read by the driver's own file server only
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "stockflow_code"), "zip", os.path.dirname(here),
                                     os.path.basename(here)))
    sc._stockflow_shipped = True


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared checkpoint folder, unique to this application."""
    base = ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId or uuid.uuid4().hex
    return "/".join([base.rstrip("/"), "stockflow", app, *parts])
