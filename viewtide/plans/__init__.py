"""Whole jobs and queries: batch load, reports, pipeline health."""
