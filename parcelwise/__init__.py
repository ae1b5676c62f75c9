"""Property-market analytics on Spark: staging, gap filling, star schema and measures."""
