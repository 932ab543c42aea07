"""Functions for use in SQL text.

They are SQL-defined, so the optimizer inlines them: no Python runs. An aggregate cannot be defined
this way; in SQL text a distinct concatenation is
``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_DEFINITIONS = (
    "concat_long_string(number BIGINT, txt STRING, sep STRING) RETURNS STRING "
    "RETURN concat(cast(number AS STRING), sep, coalesce(txt, 'null'))",
    "json_field(doc STRING, field STRING) RETURNS STRING "
    "RETURN get_json_object(doc, concat('$[\\'', field, '\\']'))",
    "trim_comma(txt STRING) RETURNS STRING RETURN regexp_replace(txt, '^,|,$', '')",
    "half_up_ratio(part BIGINT, whole BIGINT) RETURNS DOUBLE "
    "RETURN CASE WHEN whole > 0 THEN ((200 * part + whole) div (2 * whole)) / 100.0D ELSE 0.0D END",
)


def register(spark: SparkSession) -> None:
    """Register the functions for this session; registering again is harmless."""
    for definition in _DEFINITIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")
