"""Publishing of environmental monitoring packages as Spark DataFrame jobs."""
