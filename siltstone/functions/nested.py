"""Arrays, key/value lists and literal maps, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def explode_items(df: DataFrame, array: str, item: str) -> DataFrame:
    """One row per array element; a null or empty array keeps its row, element null."""
    return df.withColumn(item, F.explode_outer(F.col(array)))


def join_field(array: Column | str, field: str, separator: str = ", ") -> Column:
    """The named field of each struct, joined into one string; nulls are skipped."""
    return F.array_join(F.transform(array, lambda item: item.getField(field)), separator)


def count_items(array: Column | str) -> Column:
    """Number of elements; 0 for a null array."""
    return F.coalesce(F.size(array), F.lit(0))


def count_items_where(array: Column | str, field: str, value: str) -> Column:
    """Number of structs whose text field equals ``value``, ignoring case."""
    wanted = value.lower()
    return count_items(F.filter(array, lambda item: F.lower(item.getField(field)) == wanted))


def property_value(array: Column | str, key: str) -> Column:
    """Value of the first ``{key, value}`` entry with this key, or null.

    A position search over the keys compiles to plain code, where a filter with
    a lambda would be interpreted for every property of every row.
    """
    entries = F.col(array) if isinstance(array, str) else array
    position = F.array_position(entries.getField("key"), key).cast("int")
    return F.get(entries.getField("value"), position - 1)


def property_columns(array: Column | str, keys: Sequence[str]) -> list[Column]:
    """One column per key, named in lower case."""
    return [property_value(array, k).alias(k.lower()) for k in keys]


def lookup(values: Mapping[str, str], key: Column | str) -> Column:
    """Value of ``key`` in a literal map, null when absent."""
    entries = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), F.col(key) if isinstance(key, str) else key)
