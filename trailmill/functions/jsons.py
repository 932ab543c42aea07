"""Reading fields out of JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def json_field(value: Column | str, field: str) -> Column:
    """A field by its bare name; NULL for malformed text or a missing field."""
    return F.get_json_object(_col(value), f"$['{field}']")


def task_param(value: Column | str, field: str) -> Column:
    """First element of a task parameter array held in a JSON column."""
    return F.get_json_object(_col(value), f"$['{field}'][0]")


def product_status(extend_info: Column | str) -> Column:
    """``Self`` for status 0, ``Third Party`` for every other status and for none."""
    return F.when(json_field(extend_info, "product_status") == "0", "Self").otherwise(
        "Third Party"
    )
