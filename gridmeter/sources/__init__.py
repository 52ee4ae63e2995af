"""Sources and sinks: table scans, landed JSON documents, Parquet outputs."""
