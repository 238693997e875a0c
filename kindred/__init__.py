"""kindred: record linkage as Spark DataFrame jobs."""
