"""Scalar functions over Columns: names, times, JSON, image metadata."""
