"""Sources and sinks: parquet tables, raw CSV files, the test binding."""
