"""Training-data operators: de-duplication, filtering, packing, tokenising, sharding, chat formatting."""
