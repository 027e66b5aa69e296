"""Table-level operators: keyed dedup and merges, dimension joins, data quality."""
