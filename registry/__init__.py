"""Queries over the test tables, one per operator, with SQL equivalents."""
