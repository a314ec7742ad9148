"""Sources and sinks: CSV and Parquet scans, catalog tables, the feature table,
prediction batches."""
