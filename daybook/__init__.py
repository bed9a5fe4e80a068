"""Daily user-activity analytics as Spark DataFrame plans."""
