"""Usage-metrics analytics on Spark: reports in, curated views and measures out."""
