"""Training-data operators: media, tokens, quality, deduplication, mixing and privacy."""
