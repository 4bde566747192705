"""DataFrame operators: validation, lateness, gaps, metrics, tables, rollups."""
