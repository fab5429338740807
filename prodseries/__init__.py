"""Monthly production series analytics, expressed as Spark DataFrame plans."""
