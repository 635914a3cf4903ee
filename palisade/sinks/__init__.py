"""Writers: partitioned Parquet, quarantine, message topics."""
