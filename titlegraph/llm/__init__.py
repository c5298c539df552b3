"""Training-data operators: sharding, token files, extraction, filters, decontamination, search, dedup, tokenizing."""
