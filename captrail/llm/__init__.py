"""Training-data operators: quality, language, deduplication, secrets, mixing, tokens, vector search."""
