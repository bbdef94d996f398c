"""Retail market analytics and training-data preparation on Spark."""
