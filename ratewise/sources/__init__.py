"""Scans and sinks: review tables, feature tables, reports and run logs."""
