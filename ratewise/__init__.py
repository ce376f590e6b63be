"""Ratewise: Spark jobs that turn rated text into features, models and reports."""

__version__ = "0.1.0"
