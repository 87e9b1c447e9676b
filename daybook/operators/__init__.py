"""DataFrame building blocks: scans, the sales fact, metrics."""
