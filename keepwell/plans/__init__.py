"""Composite queries: extraction, reports, evaluation, impact and training."""
