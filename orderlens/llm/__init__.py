"""Operators of a training-data pipeline; queries.py registers one query for each."""
