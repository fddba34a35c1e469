"""DataFrame operators: dedup, MERGE, statistics, file skipping, record conversion."""
