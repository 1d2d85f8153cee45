"""Operators of a large-scale training-data pipeline (self-contained subpackage)."""
