"""DataFrame operators: routing, merging and reporting."""
