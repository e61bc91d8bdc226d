"""Registered queries (spark, sf_dir) -> DataFrame and their DuckDB oracle SQL."""
