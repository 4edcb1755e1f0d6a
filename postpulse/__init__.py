"""Per-topic analytics over short social posts, expressed as Spark DataFrames."""
