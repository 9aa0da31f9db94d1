"""Training-data operators: extraction, deduplication, scoring, mixing and tokenizing at scale."""
