"""Sources and sinks: driver-table scans, the star panel, CSV/parquet/JSON writers."""
