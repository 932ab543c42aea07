"""Sources: behaviour tables, dimension tables, the ad-click log."""

from . import adlog, jdbc, tables

__all__ = ["adlog", "jdbc", "tables"]
