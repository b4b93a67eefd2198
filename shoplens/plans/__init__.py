"""Query catalog, DuckDB oracle SQL and the three job runners."""
