"""Training-data operators: language id, extraction, packing, archives,
fingerprints, tokenisation, search, classifiers, near-duplicate joins."""
