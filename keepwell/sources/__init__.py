"""Readers, sinks and the binding of the test tables to the churn schema."""
