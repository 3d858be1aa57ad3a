"""The analytical query catalogue: metrics, KPIs, distributions, and the registry
of queries over the driver tables with their DuckDB oracles."""
