"""Training-data operators: mixing, deduplication, fingerprints, language,
tokens, nearest neighbours, page text and quality."""
