"""Relational building blocks: windows, joins, statistics."""
