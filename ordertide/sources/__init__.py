"""Where rows come from: topics, files, dimension tables, generated sequences."""
