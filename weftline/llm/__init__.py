"""Training-data operators: token counts, sharding, scans, scores, duplicates, retrieval."""
