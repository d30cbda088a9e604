"""Training-data operators: near-dedup, fingerprints, sharding, chat formatting,
language and quality filters, mixing, URL filters and BPE."""
