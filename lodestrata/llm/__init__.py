"""Training-data operators: language id, dedup, extraction, scoring, packing, mixing."""
