"""Operators of a training-data pipeline: one module per operator, their queries in `queries`."""
