"""String helpers as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _literal_pattern(text: str) -> str:
    """Quote ``text`` for a Java regular expression."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def is_empty(value: Column | str) -> Column:
    value = _col(value)
    return value.isNull() | (value == "")


def is_not_empty(value: Column | str) -> Column:
    return ~is_empty(value)


def trim_comma(value: Column | str) -> Column:
    """Drop one comma at each end."""
    return F.regexp_replace(_col(value), "^,|,$", "")


def pad_two(value: Column | str) -> Column:
    """Prefix a ``0`` unless the text already has two characters."""
    value = _col(value)
    return F.when(F.length(value) == 2, value).otherwise(F.concat(F.lit("0"), value))


def get_field(value: Column | str, field: str, delimiter: str = "\\|") -> Column:
    """Value of the first ``field=value`` part; NULL when absent or empty.

    ``delimiter`` is a regular expression. A part with more than one value is not a field.
    """
    pattern = f"^{_literal_pattern(field)}=([^=]+)=*$"
    parts = F.filter(F.split(_col(value), delimiter), lambda part: part.rlike(pattern))
    return F.regexp_extract(F.get(parts, F.lit(0)), pattern, 1)


def set_field(
    value: Column | str, field: str, new_value: Column | str, delimiter: str = "\\|"
) -> Column:
    """Give the first part named ``field`` a new value (NULL is written ``null``).

    Other parts, and their order, stay.
    """
    new_value = F.lit(new_value) if isinstance(new_value, str) else new_value
    parts = F.split(F.regexp_replace(_col(value), f"(?:{delimiter})+$", ""), delimiter)
    names = F.transform(parts, lambda part: F.substring_index(part, "=", 1))
    at = F.array_position(names, field)
    replaced = F.transform(
        parts,
        lambda part, index: F.when(
            index + 1 == at, F.concat(F.lit(field + "="), F.coalesce(new_value, F.lit("null")))
        ).otherwise(part),
    )
    return F.array_join(replaced, "|")


def csv_ids(value: Column | str) -> Column:
    """``'3,17'`` as ``array<bigint>``; a part that is no number becomes a NULL element."""
    return F.split(_col(value), ",").try_cast("array<bigint>")


def concat_long_string(number: Column | str, text: Column | str, separator: str) -> Column:
    """``number``, ``separator``, ``text`` joined; a NULL text reads ``null``."""
    return F.concat(
        _col(number).cast("string"), F.lit(separator), F.coalesce(_col(text), F.lit("null"))
    )


def group_concat_distinct(value: Column | str, separator: str = ",") -> Column:
    """Aggregate: the distinct non-NULL values of a group, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(_col(value))), separator)


def distinct_items(value: Column | str) -> Column:
    """List without repeats, in order of first appearance."""
    return F.array_distinct(_col(value))
