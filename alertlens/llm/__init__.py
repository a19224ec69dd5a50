"""Training-data operators: mixing, deduplication, scoring, encoding, filtering, sharding."""
