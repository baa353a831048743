"""Writers: partitioned tables, partition publishing, CSV exports."""
