"""Photo-review analytics as Spark DataFrame operators."""
