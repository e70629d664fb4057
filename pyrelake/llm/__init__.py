"""Training-data operators: quality, tokens, privacy, deduplication, language and contamination."""
