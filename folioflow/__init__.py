"""folioflow: a Spark-first engine for operations data."""
