"""Plans: the routed batch run (the stream's twin) and the report queries."""
