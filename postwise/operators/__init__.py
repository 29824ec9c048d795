"""DataFrame operators: cleaning, keys, dimensions, fact, quality, dedup."""
