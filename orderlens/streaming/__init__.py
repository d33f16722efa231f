"""Scoring of requests as they arrive."""
