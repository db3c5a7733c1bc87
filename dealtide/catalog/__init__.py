"""Queries of this package on the star-schema test tables, and SQL to check them with."""
