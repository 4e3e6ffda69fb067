"""Sources and sinks: the driver's parquet tables and the plain-text formats (token log, link
manifest, index dump, session file, cluster report)."""
