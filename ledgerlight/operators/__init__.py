"""DataFrame-in, DataFrame-out operators: staging, dimensions, facts, merges, checks."""
