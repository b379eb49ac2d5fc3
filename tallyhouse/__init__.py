"""Star-schema marketplace analytics expressed as Spark DataFrame jobs."""
