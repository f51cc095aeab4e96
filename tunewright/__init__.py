"""Spark operators for instruction-tuning corpora, their evaluation and run analytics."""

__version__ = "0.1.0"
