"""Training-data operators: counting, scoring, deduplicating, cleaning and packing text tables."""
