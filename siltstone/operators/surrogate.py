"""Dense LONG surrogate keys in natural-key order, stable across refreshes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.matching import same
from siltstone.operators.slices import POSITION, SLICE, slice_offsets, sorted_slices
from siltstone.session import materialise


def number_members(members: DataFrame, natural_key: Sequence[str], key: str, start: int = 0) -> DataFrame:
    """Number rows ``start, start + 1, ...`` by natural key, without a global sort task.

    ``members`` must be unique on the natural key.
    """
    sliced = sorted_slices(members, natural_key)
    numbered = sliced.join(F.broadcast(slice_offsets(sliced)), SLICE)
    value = F.col("_offset") + F.col(POSITION) + F.lit(start).cast("long")
    return numbered.withColumn(key, value).drop(SLICE, POSITION, "_offset")


def assign_keys(
    members: DataFrame, natural_key: Sequence[str], key: str, previous: DataFrame | None = None
) -> DataFrame:
    """Give each member its key; members of ``previous`` keep theirs, new ones follow on.

    Members that ``members`` lacks stay as they were, so no key is ever given
    again and facts that refer to a member stay valid after a refresh.
    """
    if previous is None:
        return number_members(members, natural_key, key)
    old = previous.select(*natural_key, key).alias("p")
    matched = members.alias("m").join(old, same("m", "p", natural_key), "left").select("m.*", f"p.{key}")
    matched = materialise(matched, "members")
    new = matched.where(F.col(key).isNull()).drop(key)
    highest = previous.agg(F.max(key)).first()[0]
    start = 0 if highest is None else highest + 1
    gone = previous.alias("p").join(members.select(*natural_key).alias("m"), same("p", "m", natural_key), "left_anti")
    held = [c for c in matched.columns if c in previous.columns]
    return (
        matched.where(F.col(key).isNotNull())
        .unionByName(number_members(new, natural_key, key, start))
        .unionByName(gone.select(*(f"p.{c}" for c in held)), allowMissingColumns=True)
    )
