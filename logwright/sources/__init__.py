"""Sources and sinks: raw log text, staged CSV, the Parquet store, fixtures."""
