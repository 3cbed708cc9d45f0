"""Registered end-to-end queries (``catalog``) and their DuckDB oracle SQL (``oracle``)."""
