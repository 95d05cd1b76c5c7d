"""Training-data operators: filters, extraction, de-duplication, tokenization, search and sharding on Spark."""
