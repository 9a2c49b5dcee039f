"""Training-data operators: scoring, cleaning, deduplication and encoding of text at scale."""
