"""Spark-native analytics over corpora of vulnerable and fixed code, and training-data preparation."""
