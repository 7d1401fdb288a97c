"""Sources and sinks: fixture mapping, NDJSON / variant loads, export."""
