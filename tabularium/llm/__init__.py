"""Training-data operators: sharding, language ID, WARC, BPE, fingerprints, dedup, decontamination, quality, chat."""
