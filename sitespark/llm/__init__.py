"""Operators for large-scale training-data pipelines. Nothing else in sitespark imports this package."""
