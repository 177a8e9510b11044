"""Whole jobs: the refresh of the reporting tables, and the queries over the supplied tables."""
