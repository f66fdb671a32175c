"""Training-data operators: sharding, filtering, deduplication, mixing, tokens."""
