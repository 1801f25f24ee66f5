"""Operators of a training-data pipeline (ten operators, one module each)."""
