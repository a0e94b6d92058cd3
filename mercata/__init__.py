"""Marketing and commerce analytics as Spark DataFrame functions."""
