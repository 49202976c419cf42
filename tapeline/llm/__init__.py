"""Operators of a training-data pipeline: packing, search, filters, dedup, archives."""
