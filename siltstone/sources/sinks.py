"""Writers for the layers and row metrics taken while writing."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from siltstone.functions.cleaning import PARTITION_COLUMNS
from siltstone.functions.matching import same
from siltstone.session import FREED, settings
from siltstone.sources.commits import commit, forget_keys, staged, staged_folders
from siltstone.sources.files import replace_table
from siltstone.sources.tables import read_table_if_any


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Count rows (and other aggregates) as they pass, without a second scan."""
    observation = Observation(name)
    extra = [c.alias(k) for k, c in (metrics or {}).items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra), observation


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = PARTITION_COLUMNS,
    mode: str = "overwrite",
    only_touched: bool = False,
    fmt: str = "parquet",
    filed: bool = False,
    emptied: Collection[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a table in folders; ``options`` are those of its format.

    Rows are rebalanced by folder first: small folders get one file instead of
    one per task, and a folder with a large share of the rows is split over
    many tasks.  Rows that come from a table in the same folders and were not
    shuffled since are ``filed`` already and spared that shuffle.  With
    ``only_touched`` an overwrite keeps the folders that the new rows do not
    mention, but for those ``emptied``; without it the whole table is replaced.
    Either way the table stays as it was should the write fail, and a stop while
    folders are put in place is made good later.
    """
    writer = (df if filed else df.hint("rebalance", *columns)).write.partitionBy(*columns).format(fmt).options(**(options or {}))
    spark = df.sparkSession
    with settings(spark, FREED):
        if mode != "overwrite":
            forget_keys(spark, path)
            writer.mode(mode).save(path)
        elif only_touched:
            change = staged(spark, path)
            writer.mode("error").save(f"{change}/rows")
            forget_keys(spark, path)
            written = staged_folders(spark, change, "rows", columns)
            commit(spark, path, change, {f"rows/{f}": f for f in written}, set(emptied) - set(written))
        else:
            replace_table(spark, path, lambda target: writer.mode("error").save(target))


def write_dimension(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table, which ``df`` may read."""
    with settings(df.sparkSession, FREED):
        replace_table(df.sparkSession, path, lambda staged: df.write.parquet(staged))


def append_new(
    df: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str] = PARTITION_COLUMNS
) -> None:
    """Append the rows whose key the table does not hold yet, so reruns add nothing.

    ``df`` must be unique on ``keys``.  Only the key columns of the table are read.
    """
    existing = read_table_if_any(df.sparkSession, path)
    if existing is not None:
        df = df.alias("n").join(existing.select(*keys).alias("e"), same("n", "e", keys), "left_anti")
    write_partitioned(df, path, columns, mode="append")
