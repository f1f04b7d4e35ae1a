"""Defaults, lenient casts and lookups in action lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or(column: Column, type_name: str, default: int | float, lenient: bool = False) -> Column:
    """Text as a number, ``default`` where it is absent.

    Malformed text raises; with ``lenient`` it counts as absent.
    """
    number = column.try_cast(type_name) if lenient else column.cast(type_name)
    return F.coalesce(number, F.lit(default).cast(type_name))


def action_count(actions: Column, action_type: str, lenient: bool = False) -> Column:
    """Value of the last entry of that type; 0 for none or for a missing list.

    Both fields are taken as arrays, newest entry first, and looked up by
    position: unlike a lambda over the entries this compiles, and the reversed
    arrays are shared by all types looked up in one projection.
    """
    types, values = F.reverse(actions["action_type"]), F.reverse(actions["value"])
    position = F.nullif(F.array_position(types, action_type), F.lit(0)).cast("int")
    return number_or(F.try_element_at(values, position), "bigint", 0, lenient)


def present_only(*items: Column) -> Column:
    """Array of the items that are not NULL, in order."""
    return F.filter(F.array(*items), lambda item: item.isNotNull())


def to_megabytes(size: Column) -> Column:
    return F.round(size / F.lit(1024 * 1024), 2)


def from_millis(column: Column) -> Column:
    return F.timestamp_millis(column)
