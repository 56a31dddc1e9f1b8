"""Composed plans: the spark-submit jobs and the registered query catalog."""
