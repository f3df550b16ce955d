"""Where rows go: partitions, typed Parquet, reports."""
