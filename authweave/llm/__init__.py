"""Operators and pipeline for building training data; nothing outside imports this package."""
