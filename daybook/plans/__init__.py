"""Reports and the jobs that run them."""
