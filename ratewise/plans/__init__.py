"""Whole jobs: the stages from review file to report, and the query catalog."""
