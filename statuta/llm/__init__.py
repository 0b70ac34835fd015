"""Training-data operators: fingerprints, mixing, token counts, search, chat formatting,
deduplication, quality and toxicity scoring, and byte-level BPE."""
