"""Spark-native analytics for job-posting data."""
