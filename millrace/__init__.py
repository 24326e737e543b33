"""Spark-native data preparation, evaluation and monitoring for fine-tuning corpora."""

__version__ = "0.1.0"
