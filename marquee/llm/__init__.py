"""Training-data operators: token files, dedup, fingerprints, archives, quality, language, packing."""
