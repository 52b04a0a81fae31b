"""Sorted slices of a table: order across tasks without a task that holds a whole key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.session import materialise

SLICE = "_slice"
POSITION = "_position"

# monotonically_increasing_id() keeps the row number within a task in its low 33 bits.
_ROW_BITS = 33


def sorted_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition and sort by ``order``, then number the slices and their rows.

    The order columns together should identify a row: then one value of the
    leading column, however frequent, spreads over many slices.  The result is
    a written table, so that every later step sees the same slices.
    """
    sort = [F.col(c).asc_nulls_first() for c in order]
    numbered = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn(
        "_id", F.monotonically_increasing_id()
    )
    slice_id = F.shiftright("_id", _ROW_BITS)
    placed = numbered.withColumns(
        {SLICE: slice_id, POSITION: F.col("_id") - F.shiftleft(slice_id, _ROW_BITS)}
    ).drop("_id")
    return materialise(placed, "slices")


def slice_offsets(sliced: DataFrame) -> DataFrame:
    """Rows that precede each slice; one row per slice, so a single window task is enough."""
    sizes = sliced.groupBy(SLICE).agg((F.max(POSITION) + 1).alias("_size"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(SLICE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))


def with_neighbour(
    sliced: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, step: int
) -> DataFrame:
    """Add struct ``name``: ``columns`` of the previous (-1) or next (+1) row of the same key.

    Within a slice a window finds it.  At a slice's edge it is the edge row of
    the neighbouring slice; there is one such row per slice, so that table is
    bounded by the number of slices and safe to broadcast.
    """
    if step not in (-1, 1):
        raise ValueError("step must be -1 or 1")
    towards = F.col(POSITION).asc() if step < 0 else F.col(POSITION).desc()
    across = F.col(SLICE).asc() if step < 0 else F.col(SLICE).desc()
    whole = F.struct(*dict.fromkeys([*keys, *columns]))

    end = (F.max if step < 0 else F.min)(POSITION).alias(POSITION)
    ends = F.broadcast(sliced.groupBy(SLICE).agg(end))
    edges = sliced.join(ends, [SLICE, POSITION]).select(SLICE, whole.alias("_edge"))
    carried = edges.select(SLICE, F.lag("_edge").over(Window.orderBy(across)).alias("_edge"))

    beside = F.lag(whole).over(Window.partitionBy(SLICE).orderBy(towards))
    found = sliced.withColumn("_beside", beside).join(F.broadcast(carried), SLICE, "left")
    neighbour = F.coalesce("_beside", "_edge")
    same: Column = neighbour.isNotNull()
    for k in keys:
        same = same & neighbour.getField(k).eqNullSafe(F.col(k))
    picked = F.struct(*(neighbour.getField(c).alias(c) for c in columns))
    return found.withColumn(name, F.when(same, picked)).drop("_beside", "_edge")
