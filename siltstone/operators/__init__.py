"""Operators on whole tables: deduplication, keys, joins, merges, quality, messages."""
