"""Feedback mining on Spark: extract pains, classify, match to canonicals, report."""

__version__ = "0.1.0"
