"""Scalar functions as Columns."""
