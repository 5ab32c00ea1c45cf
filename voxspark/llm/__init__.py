"""Training-data operators: sharding, decontamination, set joins, chat formatting, HTML
extraction, packing, PII, vector near-duplicates, token counts, quality rules."""
