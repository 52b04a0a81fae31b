"""States of a table's folders, kept in a table of their own and merged into results.

A state is what one folder adds to a result: sums, counts, sketches, distinct
values.  States lie in the same folders as the rows.  When the table changes, only
folders whose files are no longer those a state was made from are read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.functions.cleaning import PARTITION_COLUMNS
from siltstone.functions.folders import folder, in_folders
from siltstone.sources.commits import commit, landed_files, staged, staged_folders
from siltstone.sources.tables import read_table, read_table_if_any

#: A hash of the names, sizes and times of the files a state was made from.
MARK = "_made_from"


def _marks(spark: SparkSession, path: str, columns: Sequence[str]) -> dict[str, int]:
    """The present mark of every folder, from a listing; no file is opened."""
    pattern = "/(" + "/".join(f"{c}=[^/]*" for c in columns) + ")/[^/]*$"
    listed = landed_files(spark, path).select(
        F.regexp_extract("file", pattern, 1).alias("f"), F.xxhash64("file", "size", "time").alias("h")
    )
    # Names of folders are as many as the table has days.
    return {r["f"]: r["h"] for r in listed.where("f <> ''").groupBy("f").agg(F.bit_xor("h").alias("h")).collect()}


def keep_states(
    spark: SparkSession,
    table_path: str,
    states_path: str,
    state: Callable[[DataFrame, Sequence[str]], DataFrame],
    columns: Sequence[str] = PARTITION_COLUMNS,
) -> set[str]:
    """Bring the states of a table up to date; the folders that were read for it.

    ``state(rows, columns)`` gives at least one row for each folder that has rows,
    grouped by the folder ``columns`` among others.  The files are listed before
    they are read, so one that lands meanwhile is taken in by the next run at the
    latest.  Folders that have gone lose their state.  All states change in one
    commit, which survives a stop.
    """
    change = staged(spark, states_path)
    present = _marks(spark, table_path, columns)
    held = read_table_if_any(spark, states_path)
    known = {} if held is None else {
        r["f"]: r[MARK] for r in held.select(folder(columns).alias("f"), MARK).distinct().collect()
    }
    stale = {f for f, mark in present.items() if known.get(f) != mark}
    gone = set(known) - set(present)
    if not stale and not gone:
        return set()
    written: list[str] = []
    if stale:
        rows = state(read_table(spark, table_path).where(in_folders(columns, stale)), columns)
        marks = spark.createDataFrame([(f, present[f]) for f in sorted(stale)], f"_f string, {MARK} long")
        # One row a folder, as many as the list of folders that the driver holds.
        marked = rows.withColumn("_f", folder(columns)).join(F.broadcast(marks), "_f").drop("_f")
        marked.hint("rebalance", *columns).write.partitionBy(*columns).parquet(f"{change}/rows")
        written = staged_folders(spark, change, "rows", columns)
    removes = (stale & set(known)) - set(written) | gone
    commit(spark, states_path, change, {f"rows/{f}": f for f in written}, removes)
    return stale


def read_states(spark: SparkSession, states_path: str) -> DataFrame:
    """The states of all folders, to be merged."""
    return read_table(spark, states_path).drop(MARK)
