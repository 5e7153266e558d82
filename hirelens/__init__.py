"""Job-market analytics as Spark DataFrame transforms."""
