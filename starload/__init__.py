"""Star-schema loading as set-based Spark jobs."""
