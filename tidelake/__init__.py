"""A market-data lakehouse on Spark: marts, checks, lake upkeep and training-data operators."""
