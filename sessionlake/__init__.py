"""Session analytics on a data lake, written as plain Spark jobs."""
