"""Equivalent SQL (DuckDB dialect) for every registered query, and a
side-by-side comparison used by the tests."""
