"""Naming and selecting the folders of a partitioned table."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the folder in which Spark files rows whose partition column is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def folder(columns: Sequence[str]) -> Column:
    """Relative path of the folder a row is filed in, ``_year=2024/_month=1/_day=5``."""
    values = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_FOLDER))) for c in columns]
    return F.concat_ws("/", *values)


def folders_of(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """The folders that hold rows of ``df``: as many names as the table has days."""
    return {row["f"] for row in df.select(folder(columns).alias("f")).distinct().collect()}


def in_folders(columns: Sequence[str], names: Collection[str]) -> Column:
    """Predicate on partition columns only, so that a scan opens no other folder."""
    return folder(columns).isin(sorted(names)) if names else F.lit(False)
