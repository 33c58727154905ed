"""Training-data operators: cleaning, deduplication, tokenising, packing and search over large text tables."""
