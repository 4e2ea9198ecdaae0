"""stockflow — supply-chain analytics on Spark DataFrames.

Layers:

* ``sources``   – readers and writers (CSV with explicit schemas, parquet
  warehouse tables) and the stand-in inputs built from the test tables.
* ``functions`` – column expressions (calendar attributes, rounding, ratios).
* ``operators`` – DataFrame -> DataFrame building blocks (dimensions, facts,
  stock ledger, ranking, demand features, forest model).
* ``plans``     – the user-level queries (eight KPIs, load validation,
  forecast reports, dashboard figures) and their DuckDB oracle text.
* ``streaming`` – nothing: the reference has no streaming work.
"""

from stockflow.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
