"""cellwright: analytic questions about tables, answered as Spark jobs."""
