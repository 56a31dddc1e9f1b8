"""Spark sources and sinks: table readers/writers and synthetic data."""
