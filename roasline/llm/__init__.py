"""Training-data operators: extraction, cleaning, deduplication, mixing, sharding, tokenising."""
