"""Deduplication with a survivor that does not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _comparable(field: T.StructField) -> Column:
    """A column as something that can be sorted: maps compare by their JSON text."""
    column = F.col(f"`{field.name}`")
    return F.to_json(column) if isinstance(field.dataType, T.MapType) else column


def survivor_order(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str] = (), oldest: Sequence[str] = (), apart: Sequence[str] = ()
) -> list[Column]:
    """Newest first, then lowest of ``oldest``, then a total order over the other columns but those ``apart``."""
    named = {*keys, *newest, *oldest, *apart}
    rest = [f for f in df.schema.fields if f.name not in named]
    return [
        *(F.col(c).desc_nulls_last() for c in newest),
        *(F.col(c).asc_nulls_last() for c in oldest),
        *(_comparable(f).asc_nulls_last() for f in rest),
    ]


def dedup_latest(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str] = (), oldest: Sequence[str] = (), apart: Sequence[str] = ()
) -> DataFrame:
    """One row per key; null keys are equal to each other.

    The rank filter is applied inside every input task before the shuffle, so
    a key with any number of copies sends at most one row per task.
    """
    order = survivor_order(df, keys, newest, oldest, apart) or [F.lit(0)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_attributes(df: DataFrame, keys: Sequence[str], attributes: Sequence[str], newest: str) -> DataFrame:
    """``dedup_latest`` for a table with few distinct attribute values, as a dimension's source is.

    Rows are first hash-aggregated to one per key and attribute values, so the
    many rows of a fact are neither sorted nor shuffled.
    """
    readings = df.groupBy(*keys, *attributes).agg(F.max(newest).alias(newest))
    return dedup_latest(readings, keys, [newest])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The non-null values of one column, each once."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def earliest_order(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = (), oldest: Sequence[str] = ()) -> Column:
    """The order of ``survivor_order`` as one struct whose least value is the survivor, holding all columns but the keys.

    ``newest`` must be times.  For aggregates that keep a minimum, as streams do.
    """
    def nulls_last(value: Column, name: str) -> Column:
        return F.struct(value.isNull().alias("missing"), value.alias("value")).alias(name)

    parts = [nulls_last(-F.unix_micros(F.col(c)), c) for c in newest]
    parts += [nulls_last(F.col(c), c) for c in oldest]
    named = {*keys, *newest, *oldest}
    parts += [nulls_last(F.col(f"`{f.name}`"), f.name) for f in df.schema.fields if f.name not in named]
    return F.struct(*parts)


def survivor_columns(least: str, df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> list[Column]:
    """The columns of ``df`` from its keys and the struct that ``earliest_order`` made."""
    def restored(field: T.StructField) -> Column:
        if field.name in keys:
            return F.col(field.name)
        value = F.col(f"{least}.`{field.name}`.value")
        return (F.timestamp_micros(-value) if field.name in newest else value).alias(field.name)

    return [restored(f) for f in df.schema.fields]
