"""Casting, string cleaning, required fields, audit and partition columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

PARTITION_COLUMNS = ("_year", "_month", "_day")


def as_timestamp(column: Column | str) -> Column:
    """ISO text (naive, ``Z`` or offset) to timestamp; anything else becomes null."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column)


def with_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: as_timestamp(c) for c in columns})


# Texts that read as a truth value, whatever their case.
TRUE_TEXTS = ("true", "t", "yes", "y", "1")
FALSE_TEXTS = ("false", "f", "no", "n", "0")


def as_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False)


def as_whole(text: Column, kind: str) -> Column:
    """Whole number in a text, its decimals cut off."""
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)(\.\d*)?\s*$", 1)
    return F.nullif(digits, F.lit("")).try_cast(kind)


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns without failing: a bad value becomes null and the row stays.

    Texts are examined before they are cast to whole numbers or truth values:
    ``try_cast`` alone refuses decimals where a whole number is wanted, and it
    raises and catches an exception for each bad value, some 20 microseconds
    apiece.
    """
    def typed(name: str, kind: str) -> Column:
        column = F.col(name)
        if isinstance(df.schema[name].dataType, T.StringType):
            if kind == "boolean":
                return as_boolean(column)
            if kind in ("int", "bigint"):
                return as_whole(column, kind)
        return column.try_cast(kind)

    return df.withColumns({c: typed(c, t) for c, t in types.items()})


def with_trimmed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def normalised(column: Column | str) -> Column:
    """Lower-cased text without surrounding spaces."""
    return F.lower(F.trim(F.col(column) if isinstance(column, str) else column))


def with_normalised(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: normalised(c) for c in columns})


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows that have a value in every one of ``columns``."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def clean_markup(text: Column | str) -> Column:
    """Decode the entities found in feed text, then turn line breaks into spaces.

    The ampersand is decoded last, so that ``&amp;lt;`` becomes ``&lt;`` and is
    not decoded twice.
    """
    out = F.col(text) if isinstance(text, str) else text
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.regexp_replace(out, r"<br\s*/?>", " ")


def drop_markup(text: Column | str) -> Column:
    """The feed's older cleaning: ``<br/>`` to a space, entities removed undecoded."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.replace(column, F.lit("<br/>"), F.lit(" ")), "&(lt|gt|#39|amp);", "")


def part(column: Column | str, separator: str, index: int) -> Column:
    """The ``index``-th piece of a separated string, null when there is none."""
    value = F.col(column) if isinstance(column, str) else column
    return F.get(F.split(value, rf"\Q{separator}\E"), F.lit(index))


def banded(value: Column, bands: Sequence[tuple[int, int, str]], otherwise: str | None) -> Column:
    """Name of the first inclusive ``(low, high, name)`` band that holds ``value``.

    A null value is in no band and takes ``otherwise``.
    """
    (low, high, name), *rest = bands
    out = F.when(value.between(low, high), name)
    for low, high, name in rest:
        out = out.when(value.between(low, high), name)
    return out.otherwise(F.lit(otherwise))


def with_audit(df: DataFrame, name: str, at: str | None = None) -> DataFrame:
    """Stamp rows with the processing time, or with a given one so reruns agree."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn(name, stamp)


def with_partition_columns(df: DataFrame, time_column: str) -> DataFrame:
    """Add the year, month and day the row is filed under."""
    t = F.col(time_column)
    return df.withColumns(dict(zip(PARTITION_COLUMNS, (F.year(t), F.month(t), F.dayofmonth(t)))))
