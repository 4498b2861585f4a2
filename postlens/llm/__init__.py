"""Operators that a training-data pipeline needs, each with its query."""
