"""Recommendation analytics over rating data, expressed as Spark DataFrame plans."""
