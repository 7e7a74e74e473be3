"""Column functions: counter arithmetic and time buckets."""
