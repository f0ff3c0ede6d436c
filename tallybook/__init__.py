"""Cloud-billing and event-log analytics as Spark DataFrame jobs."""
