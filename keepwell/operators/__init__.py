"""Reusable DataFrame operators: joins, ordering, cleaning, features, balancing."""
