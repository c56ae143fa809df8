"""Writers: CSV export, year-partitioned tables, chunked appends, layers."""
