"""Training-data pipeline operators: deduplication, filtering, encoding, packing, sharding."""
