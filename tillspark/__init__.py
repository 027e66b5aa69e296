"""Retail sales analytics as plain Spark DataFrame functions."""

from tillspark.session import build_session

__all__ = ["build_session"]
