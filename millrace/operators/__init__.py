"""DataFrame-in, DataFrame-out operators: merges, chunking, parsing, comparison, schema."""
