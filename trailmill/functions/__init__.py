"""Scalar and aggregate functions, as Column expressions."""

from . import jsons, numbers, sql, text, times

__all__ = ["jsons", "numbers", "sql", "text", "times"]
