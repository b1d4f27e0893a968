"""A Spark-first engine for frame-indexed clip data."""
