"""Event-log analytics and training-corpus preparation as Spark DataFrame jobs."""
