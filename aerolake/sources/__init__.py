"""Sources and sinks: text ingest, Parquet files, the airport seed, catalog and JDBC."""
