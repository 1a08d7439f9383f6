"""Sources and sinks: parquet tables, CSV/JSON, workbook and image folders,
staged (safe) writes, small literal tables."""
