"""Queries that exercise the operators on the driver's tables, each beside the same rule in SQL."""
