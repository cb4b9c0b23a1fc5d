"""DataFrame operators: cells, conversion, cleaning, indexing, matching, lookups."""
