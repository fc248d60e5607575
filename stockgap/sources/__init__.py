"""Sources and sinks: parquet scans, CSV load/export, driver-table binding."""
