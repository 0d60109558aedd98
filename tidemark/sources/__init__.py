"""Reading and writing: bronze files, tables, parquet, CSV, messages."""
