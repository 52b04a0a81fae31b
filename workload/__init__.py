"""Queries that run the library over the supplied tables, and their SQL twins."""
