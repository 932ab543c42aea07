"""Sinks: appends, slice replacement, and tables written batch by batch, whole or by day."""

from . import days, tables

__all__ = ["days", "tables"]
