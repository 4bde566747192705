"""Sources and sinks: driver tables, CSV files, JSON messages, Kafka edges, synthetic series."""
