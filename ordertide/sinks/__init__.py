"""Where rows go: batch-partitioned tables, topics, keyed database tables."""
