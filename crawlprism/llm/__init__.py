"""Training-data operators: extraction, scoring, filtering, deduplication, packing and formatting of texts."""
