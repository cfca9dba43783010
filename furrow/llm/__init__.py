"""Training-data operators: language, duplicates, contamination, personal data, packing and more."""
