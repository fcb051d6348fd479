"""Training-data operators: tokens, sharding, deduplication, filtering and packing."""
