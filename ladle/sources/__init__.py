"""Sources and sinks: given tables, derived views, CSV/Parquet/JSON IO, stored tables."""
