"""Training-data operators: deduplication, mixing, filtering, archives, scoring."""
