"""Linear classification with Spark ML."""
