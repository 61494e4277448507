"""Docket analytics on Spark: clean, summarise, learn from and score case records."""
