"""Training-data operators: cleaning, deduplication, mixing, tokenising and
scanning of text corpora. Nothing else in the library imports this package."""
