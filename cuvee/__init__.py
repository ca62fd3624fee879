"""Review-rating analytics as Spark jobs."""
