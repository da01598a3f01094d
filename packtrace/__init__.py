"""Battery-fleet analytics as Spark DataFrame jobs."""
