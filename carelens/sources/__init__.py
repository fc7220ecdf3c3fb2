"""Sources (parquet tables, CSV claim files, the TPC-H-style adapter) and sinks."""
