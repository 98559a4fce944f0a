"""Operators for large-scale training-data pipelines (scans, joins, packing, scoring)."""
