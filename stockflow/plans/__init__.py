"""User-level queries over the star schema, and their DuckDB oracle text."""
