"""Operators: filters, aggregates, pivots, joins, ordering and quantiles."""
