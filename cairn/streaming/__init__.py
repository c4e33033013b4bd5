"""Scoring of conversions as they arrive."""
