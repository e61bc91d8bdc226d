"""Column-level helpers: declared JSON schemas, time and JSON functions."""
