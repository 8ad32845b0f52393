"""Customer-retention analytics as PySpark DataFrame jobs."""
