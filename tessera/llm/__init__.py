"""Training-data operators: tokens, scoring, deduplication, packing, rules, shards, mixing."""
