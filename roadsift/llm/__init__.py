"""Training-data operators: sharding, deduplication, filtering, tokenizing, packing, search."""
