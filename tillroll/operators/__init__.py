"""DataFrame-in, DataFrame-out operators: Silver, marts, ranks,
profiling, checks and enrichment."""
