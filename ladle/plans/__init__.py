"""Named query plans over the given tables, each with its DuckDB oracle SQL."""
