"""Bank-transaction analytics and client graphs as plain Spark DataFrame jobs."""
