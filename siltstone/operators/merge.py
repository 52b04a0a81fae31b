"""Upsert, incremental load, slowly changing dimensions, schema evolution.

Tables are plain Parquet.  A path that is being read is never overwritten:
what replaces a folder is first written elsewhere in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from siltstone.functions.cleaning import PARTITION_COLUMNS
from siltstone.functions.folders import folders_of, in_folders
from siltstone.functions.matching import same
from siltstone.operators.dedup import dedup_latest
from siltstone.operators.slices import POSITION, SLICE, sorted_slices, with_neighbour
from siltstone.session import FREED, materialise, scratch_scope, settings
from siltstone.sources.commits import (
    BAD, LOG, begin, commit, index_name, key_index, stage_beside, stage_keys, staged, staged_folders,
)
from siltstone.sources.files import folder_names, move, names_in, remove, replace_table
from siltstone.sources.tables import SCHEMA_FOLDER, read_table_if_any, schema_text

VALIDITY = ("valid_from", "valid_to", "is_current")


@dataclass(frozen=True)
class Settled:
    """How copies of equal age are settled by what they hold, so that the order of merges does not matter.

    The one with the lowest ``oldest`` stays, then the first in the order of all
    columns but those ``apart``.
    """

    oldest: tuple[str, ...] = ()
    apart: tuple[str, ...] = ()


def upsert_latest(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newest: Sequence[str], settled: Settled | None = None
) -> DataFrame:
    """Union of both sides with the newest row per key; at equal age the source wins, or what ``settled`` says."""
    if settled is not None:
        return dedup_latest(target.unionByName(source), keys, newest, settled.oldest, settled.apart)
    both = target.withColumn("_side", F.lit(0)).unionByName(source.withColumn("_side", F.lit(1)))
    return dedup_latest(both, keys, [*newest, "_side"]).drop("_side")


def upsert_table(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    columns: Sequence[str] = PARTITION_COLUMNS,
    filed_by_key: bool = False,
    outdated: Column | None = None,
    settled: Settled | None = None,
    beside: Mapping[str, DataFrame] | None = None,
    written: bool = False,
    unique: bool = False,
) -> set[str]:
    """Merge ``source`` into a partitioned table, rewriting only the folders concerned, and name these.

    Those are the folders of the source rows and the folders that hold an older
    row of the same key.  The latter are found in the table's key index, unless
    a key always belongs to the same folder (``filed_by_key``).  The index is
    made from the key columns when a table is merged into for the first time,
    and kept with every merge.

    Columns that only one side has are kept, null on the other, and a column may
    become wider; folders that are not rewritten read null for a new column.
    Rows of the table that meet ``outdated``, a condition on the folder columns,
    go whether or not a newer row replaces them.  What is to be kept ``beside``
    the rows, as the log of files taken in, is added to what is there.  All of it
    is one commit: it is made whole or not at all.

    A source that only reads ``written`` tables, this one not among them, may be
    read twice.  If besides keys have their folders and copies are ``settled`` in
    any order, its copies meet those of the table in the one shuffle of the merge.
    A source that is ``unique`` on ``keys`` already is not searched for copies.
    """
    with scratch_scope(source.sparkSession):
        return _upsert(path, source, keys, newest, columns, filed_by_key, outdated, settled, beside or {}, written, unique)


def replace_rows(
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = PARTITION_COLUMNS,
    filed_by_key: bool = False,
    beside: Mapping[str, DataFrame] | None = None,
    keep: Sequence[str] = (),
) -> set[str]:
    """Put a table of ``rows``, unique on ``keys``, in the place of the one at ``path``, and name its folders.

    The key index and what is to stand ``beside`` the rows are part of it; of the
    old table only what ``keep`` names goes over.
    """
    spark = rows.sparkSession
    begin(spark, path)
    kept = {name: [f"{path}/{name}/{part}" for part in names_in(spark, f"{path}/{name}")] for name in keep}

    def fill(target: str) -> None:
        rows.hint("rebalance", *columns).write.partitionBy(*columns).parquet(target)
        if not filed_by_key and folder_names(spark, target, columns):
            for made, name in stage_keys(spark.read.parquet(target), target, keys, columns).items():
                move(spark, f"{target}/{made}", f"{target}/{name}")
            remove(spark, [f"{target}/keys"])
        for name, more in (beside or {}).items():
            more.write.json(f"{target}/{name}/{uuid.uuid4().hex}")
        for name, parts in kept.items():
            if parts:
                spark.read.text(parts).write.text(f"{target}/{name}/{uuid.uuid4().hex}")

    with settings(spark, FREED):
        replace_table(spark, path, fill)
    return set(folder_names(spark, path, columns))


def _upsert(path, source, keys, newest, columns, filed_by_key, outdated, settled, beside, written, unique) -> set[str]:
    spark = source.sparkSession
    begin(spark, path)
    order = (newest, settled.oldest, settled.apart) if settled is not None else (newest,)
    single = source if unique else dedup_latest(source, keys, *order)
    target = read_table_if_any(spark, path)
    if target is None:
        return replace_rows(path, single, keys, columns, filed_by_key, beside, keep=(LOG, BAD))
    if not (written and filed_by_key and settled is not None):
        # Read several times below, and perhaps derived from the table itself.
        source = materialise(single, "upsert-source", wide=True)

    change = staged(spark, path)
    schema = evolved_schema(target.schema, source.schema)
    retyped = any(f.name in target.columns and f.dataType != target.schema[f.name].dataType for f in schema.fields)
    source = conform(source, schema)
    folders = folders_of(source, columns)
    if retyped:
        # Files hold a column in one type, so a wider one is written anew everywhere.
        folders |= folders_of(target, columns)
    if outdated is not None:
        folders |= folders_of(target.where(outdated), columns)
    index = None
    if not filed_by_key and not retyped:
        index = key_index(spark, path, keys, T.StructType([target.schema[c] for c in columns]))
        held = index if index is not None else target.select(F.xxhash64(*keys).alias("h"), *columns)
        folders |= folders_of(held.join(source.select(F.xxhash64(*keys).alias("h")), "h", "left_semi"), columns)
    touched = target.where(in_folders(columns, folders))
    if outdated is not None:
        touched = touched.where(~F.coalesce(outdated, F.lit(False)))
    merged = upsert_latest(conform(touched, schema), source, keys, newest, settled)
    merged.hint("rebalance", *columns).write.partitionBy(*columns).parquet(f"{change}/rows")

    made = staged_folders(spark, change, "rows", columns)
    # A folder whose last row has moved to another one is not overwritten by any row.
    emptied = folders - set(made)
    moves, removes = {f"rows/{f}": f for f in made}, sorted(emptied)
    if not filed_by_key:
        rows = spark.read.schema(schema).parquet(f"{change}/rows")
        if index is None:
            rows = rows.select(*keys, *columns).unionByName(
                conform(target, schema).where(~in_folders(columns, folders)).select(*keys, *columns)
            )
        moves |= stage_keys(rows, change, keys, columns)
        removes += [f"{index_name(keys)}/{f}" for f in emptied]
    added, merged_parts = stage_beside(spark, path, change, beside)
    texts = {}
    if schema != target.schema or emptied:
        texts, removes = schema_text(schema), [*removes, SCHEMA_FOLDER]
    moves, removes = moves | added, removes + merged_parts
    commit(spark, path, change, moves, removes, texts)
    return folders | set(made)


def incremental_load(
    spark: SparkSession,
    staging_path: str,
    table_path: str,
    schema: T.StructType,
    keys: Sequence[str],
    newest: Sequence[str],
    columns: Sequence[str] = PARTITION_COLUMNS,
    filed_by_key: bool = False,
) -> None:
    """Merge a staging table into its fact table, then remove from staging what was merged.

    The files are listed once; those that land during the load stay for the next.
    """
    files = spark.read.schema(schema).parquet(staging_path).inputFiles()
    if files:
        staged = spark.read.schema(schema).option("basePath", staging_path).parquet(*files)
        upsert_table(table_path, staged, keys, newest, columns, filed_by_key)
        # A file without rows keeps the folder readable; the next load takes it along.
        spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(staging_path)
        remove(spark, files)
        spark.catalog.refreshByPath(staging_path)


def scd2_apply(
    dimension: DataFrame, snapshot: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: str
) -> DataFrame:
    """Apply a snapshot to a type-2 dimension.

    A member whose tracked attributes differ has its current row closed at
    ``as_of`` and a new one opened; new members are opened; members the snapshot
    lacks and rows already closed stay as they are.  Of rows that repeat a key in
    the snapshot the one with the greatest tracked attributes counts.
    """
    snapshot = dedup_latest(snapshot, keys, tracked)
    at = F.lit(as_of).cast(dimension.schema["valid_from"].dataType)
    columns = [*keys, *tracked]
    closed = dimension.where(~F.col("is_current")).select(*columns, *VALIDITY)
    current = dimension.where("is_current").select(*columns, *VALIDITY)

    old = current.select(F.struct(*columns, *VALIDITY).alias("old"), *(F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)))
    new = snapshot.select(F.struct(*columns).alias("new"), *(F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)))
    on = [F.col(f"_o{i}").eqNullSafe(F.col(f"_n{i}")) for i in range(len(keys))]
    paired = old.join(new, on, "full_outer")

    unchanged = same("old", "new", tracked)
    end = dimension.schema["valid_to"].dataType
    kept = F.col("old")
    ended = F.struct(
        *(F.col(f"old.{c}").alias(c) for c in [*columns, "valid_from"]),
        at.cast(end).alias("valid_to"), F.lit(False).alias("is_current"),
    )
    opened = F.struct(
        *(F.col(f"new.{c}").alias(c) for c in columns),
        at.alias("valid_from"), F.lit(None).cast(end).alias("valid_to"), F.lit(True).alias("is_current"),
    )
    rows = (
        F.when(F.col("new").isNull() | (F.col("old").isNotNull() & unchanged), F.array(kept))
        .when(F.col("old").isNull(), F.array(opened))
        .otherwise(F.array(ended, opened))
    )
    return closed.unionByName(paired.select(F.explode(rows).alias("_row")).select("_row.*"))


def scd2_from_history(
    history: DataFrame, keys: Sequence[str], tracked: Sequence[str], time: str
) -> DataFrame:
    """Build a type-2 dimension from a full history of attribute readings.

    A reading opens a version when its tracked attributes differ from those of
    the reading before it.  ``time`` must order the readings of one key; where
    it does not, the tracked attributes decide.  A key with any number of
    readings is spread over slices of the sorted history.
    """
    readings = history.select(*keys, time, *tracked).distinct()
    order = [*keys, time, *tracked]
    sliced = sorted_slices(readings, order)
    before = with_neighbour(sliced, keys, tracked, "_before", -1)
    repeated = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_before.{c}")) for c in tracked], F.lit(True))
    points = materialise(before.where(F.col("_before").isNull() | ~repeated).drop("_before"), "versions")
    after = with_neighbour(points, keys, [time], "_after", 1)
    return after.select(
        *keys, *tracked,
        F.col(time).alias("valid_from"),
        F.col(f"_after.{time}").alias("valid_to"),
        F.col("_after").isNull().alias("is_current"),
    ).drop(SLICE, POSITION)


READ_AT = "read_at"


def scd2_splice(
    dimension: DataFrame | None, snapshots: DataFrame, keys: Sequence[str], tracked: Sequence[str], time: str
) -> DataFrame:
    """Take snapshots of any age into a type-2 dimension, whatever order they arrive in.

    Each row keeps in ``read_at`` the times at which its version was read; a late
    reading between two of them splits the version, and one at a version's own
    time moves its start.  So the dimension is the one that all readings, sorted,
    would give.  ``snapshots`` hold keys, tracked attributes and ``time``; of
    readings of a key at one time those with the greatest attributes count.  Only
    keys that ``snapshots`` name are rebuilt.  Members a snapshot lacks stay as
    they are, null keys are a member of their own, readings without time are ignored.

    A key has at most one reading for each snapshot, so none outgrows a task.
    """
    readings = snapshots.where(F.col(time).isNotNull()).select(*keys, *tracked, F.col(time).alias("_t"))
    if dimension is None:
        return _versions(readings, keys, tracked)
    named = readings.select(*(F.col(k).alias(f"_n{i}") for i, k in enumerate(keys))).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"_n{i}")) for i, k in enumerate(keys)]
    earlier = dimension.join(named, on, "left_semi").select(*keys, *tracked, F.explode(READ_AT).alias("_t"))
    untouched = dimension.join(named, on, "left_anti")
    rebuilt = _versions(earlier.unionByName(readings), keys, tracked)
    return untouched.select(*rebuilt.columns).unionByName(rebuilt)


def _versions(readings: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Versions of readings (keys, tracked, ``_t``), with the times each was read at."""
    single = dedup_latest(readings, [*keys, "_t"], tracked)
    by_time = Window.partitionBy(*keys).orderBy("_t")
    attributes = F.struct(*tracked)
    single = single.withColumns({"_before": F.lag(attributes).over(by_time), "_first": F.row_number().over(by_time) == 1})
    opens = F.col("_first") | ~F.col("_before").eqNullSafe(attributes)
    numbered = single.withColumn("_version", F.sum(F.when(opens, 1).otherwise(0)).over(by_time))
    # Within a version the tracked attributes are one value, nulls included.
    versions = numbered.groupBy(*keys, "_version", *tracked).agg(F.sort_array(F.collect_list("_t")).alias(READ_AT))
    begin = F.col(READ_AT)[0]
    end = F.lead(begin).over(Window.partitionBy(*keys).orderBy("_version"))
    return versions.withColumns({"valid_from": begin, "valid_to": end}).select(
        *keys, *tracked, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), READ_AT
    )


# The types a column may be widened to.
_WIDER = {T.IntegerType(): (T.LongType(), T.DoubleType()), T.LongType(): (T.DoubleType(),)}


def evolved_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both, each in the wider of its two types; other changes are errors."""
    fields = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        have = fields.setdefault(f.name, f.dataType)
        if have == f.dataType or f.dataType in (T.NullType(),):
            continue
        if f.dataType in _WIDER.get(have, ()):
            fields[f.name] = f.dataType
        elif have not in _WIDER.get(f.dataType, ()):
            raise TypeError(f"column {f.name}: cannot turn {have.simpleString()} into {f.dataType.simpleString()}")
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; columns ``df`` lacks are null."""
    return df.select(
        *((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields)
    )


def schema_evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both tables under their evolved schema."""
    schema = evolved_schema(old.schema, new.schema)
    return conform(old, schema).unionByName(conform(new, schema))
