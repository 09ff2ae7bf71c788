"""Web-text corpus building as Spark DataFrame jobs."""
