"""Message files in, partitioned Parquet tables in and out."""
