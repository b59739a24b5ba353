"""Training-data operators: packing, near-dedup, PII, language ID, search, URL and license filters, BPE, line dedup."""
