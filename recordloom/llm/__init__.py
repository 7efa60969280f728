"""Operators of a training-data pipeline: filters, joins against rules, deduplication, mixing, sharding."""
