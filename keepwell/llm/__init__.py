"""Operators and queries for preparing training data for language models."""
