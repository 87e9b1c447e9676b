"""Where rows come from: readers, ingestion and the sample-table mapping."""
