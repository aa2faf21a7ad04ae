"""Query plans: the model tables derived from the driver's parquet, the
registered queries, and their DuckDB oracle SQL."""
