"""Sources and sinks: table schemas, parquet/JDBC loading, driver-table
stand-in views, the bulk generator, seed rows, JSON export and snapshots."""
