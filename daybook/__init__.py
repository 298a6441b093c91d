"""Spending analytics on Spark: statements in, daily features, models and reports out."""
