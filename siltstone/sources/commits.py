"""Changes of a table's folders that are made whole or, after a stop, made whole later.

What a change brings is first written in a folder of its own under the table's
``_pending``.  Then a note is put there that names every move: from then on the
change counts.  A change that stopped before its note leaves the table as it was;
one that stopped later is finished by the next writer, or by a reader once the note
is so old that its writer must have stopped.  Every step looks at what is there, so
it may be taken again.

A table has one writer at a time, as the jobs of a schedule are.  Readers that
start while folders move see each folder either before or after.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siltstone.sources.files import age, exists, folder_names, move, names_in, read_text, recover, remove, write_text

#: Names that begin so are skipped by readers of the table's rows.
PENDING = "_pending"
NOTE = "note.json"
#: Seconds after which a note's writer is taken to have stopped.
STOPPED = 600
#: Lines that gave no row.
BAD = "_bad"
#: The key index: hashes of the keys of each folder.
KEYS = "_keys"
#: What has been taken in, and when a log of so many parts is written anew as one.
LOG = "_log"
LOG_PARTS = 50


def staged(spark: SparkSession, path: str) -> str:
    """A new folder for what a change brings, in the table's own file system."""
    begin(spark, path)
    return f"{path}/{PENDING}/{uuid.uuid4().hex}"


def commit(
    spark: SparkSession, path: str, change: str, moves: Mapping[str, str], removes: Collection[str] = (),
    texts: Mapping[str, str] | None = None,
) -> None:
    """Make the staged ``change`` count, and carry it out.

    ``moves`` go from names in ``change`` to names in the table, whose old folders
    give way; ``removes`` are names in the table, ``texts`` small files.
    """
    note = {"moves": dict(moves), "removes": sorted(removes), "texts": dict(texts or {})}
    write_text(spark, f"{change}/{NOTE}", json.dumps(note))
    _carry_out(spark, path, change, note)


def _carry_out(spark: SparkSession, path: str, change: str, note: dict) -> None:
    for source, target in note["moves"].items():
        if exists(spark, f"{change}/{source}"):
            aside = _set_aside(spark, path, change, target)
            if not move(spark, f"{change}/{source}", f"{path}/{target}"):
                # Someone else has moved it, and it may be what was set aside.
                move(spark, aside, f"{path}/{target}")
    for target in note["removes"]:
        _set_aside(spark, path, change, target)
    for target, text in note["texts"].items():
        write_text(spark, f"{path}/{target}", text)
    remove(spark, [change])
    spark.catalog.refreshByPath(path)


def _set_aside(spark: SparkSession, path: str, change: str, target: str) -> str:
    aside = f"{change}/old-{uuid.uuid4().hex}/{target}"
    move(spark, f"{path}/{target}", aside)
    return aside


def settle(spark: SparkSession, path: str) -> None:
    """For the writer: finish the changes that count and drop those that never did."""
    for name in names_in(spark, f"{path}/{PENDING}"):
        change = f"{path}/{PENDING}/{name}"
        text = read_text(spark, f"{change}/{NOTE}")
        if text is None:
            remove(spark, [change])
        else:
            _carry_out(spark, path, change, json.loads(text))


def begin(spark: SparkSession, path: str) -> None:
    """For the writer, before it looks at the table: make good what another run left undone."""
    recover(spark, path)
    settle(spark, path)


def ready(spark: SparkSession, path: str) -> None:
    """For readers: make good what a writer that has stopped left undone."""
    if not exists(spark, path):
        recover(spark, path)
    elif any(age(spark, f"{path}/{PENDING}/{name}/{NOTE}") > STOPPED for name in names_in(spark, f"{path}/{PENDING}")):
        settle(spark, path)


def staged_folders(spark: SparkSession, change: str, part: str, columns: Sequence[str]) -> list[str]:
    """The folders by ``columns`` that were written under ``part`` of a change."""
    return folder_names(spark, f"{change}/{part}", columns)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path``: file, size, time.  They are listed, none is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select(F.col("path").alias("file"), F.col("length").alias("size"), F.unix_micros("modificationTime").alias("time"))


_LOGGED = "file string, size long, time long"
_SET_ASIDE = "line string, reason string, file string"


def taken_in(spark: SparkSession, path: str) -> DataFrame | None:
    """The files that a table's log says it holds, or None if it has no log."""
    return read_beside(spark, path, LOG, _LOGGED)


def not_taken_in(spark: SparkSession, landed: DataFrame, path: str) -> DataFrame:
    """Landed files that the table's log lacks; one that has changed since is new again."""
    log = taken_in(spark, path)
    return landed if log is None else landed.join(log, ["file", "size", "time"], "left_anti")


def quarantined(spark: SparkSession, path: str) -> DataFrame | None:
    """Lines that were set aside when the table took in their files, or None if there are none."""
    return read_beside(spark, path, BAD, _SET_ASIDE)


def read_beside(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame | None:
    """What commits have kept under ``name`` beside the rows, or None if nothing."""
    return spark.read.schema(schema).json(f"{path}/{name}/*") if names_in(spark, f"{path}/{name}") else None


def stage_beside(spark: SparkSession, path: str, change: str, beside: Mapping[str, DataFrame]) -> tuple[dict[str, str], list[str]]:
    """Write what a change keeps beside the rows; the moves and removes that put it there.

    Every commit adds a part; a log of many parts is written anew as one.
    """
    moves, removes = {}, []
    for name, rows in beside.items():
        parts = names_in(spark, f"{path}/{name}")
        if name == LOG and len(parts) >= LOG_PARTS:
            rows = rows.unionByName(taken_in(spark, path))
            removes += [f"{name}/{p}" for p in parts]
        rows.write.json(f"{change}/beside{name}")
        moves[f"beside{name}"] = f"{name}/{uuid.uuid4().hex}"
    return moves, removes


def index_name(keys: Sequence[str]) -> str:
    return f"{KEYS}/{'-'.join(keys)}"


def forget_keys(spark: SparkSession, path: str) -> None:
    """Drop the key index of a table whose rows are about to change without it."""
    remove(spark, [f"{path}/{KEYS}"])


def key_index(spark: SparkSession, path: str, keys: Sequence[str], folders: T.StructType) -> DataFrame | None:
    """Rows (h, folder columns): the hash of every key of a table by folder, or None if it is not indexed.

    Eight bytes a key, in order, so that finding the folders of some keys reads
    neither the rows nor their key columns.
    """
    place = f"{path}/{index_name(keys)}"
    if not names_in(spark, place):
        return None
    return spark.read.schema(T.StructType([T.StructField("h", T.LongType()), *folders.fields])).parquet(place)


def stage_keys(rows: DataFrame, change: str, keys: Sequence[str], columns: Sequence[str]) -> dict[str, str]:
    """Write the index of the folders of ``rows``; the moves that put it in place."""
    spark = rows.sparkSession
    hashed = rows.select(F.xxhash64(*keys).alias("h"), *columns).hint("rebalance", *columns).sortWithinPartitions(*columns, "h")
    hashed.write.partitionBy(*columns).parquet(f"{change}/keys")
    return {f"keys/{f}": f"{index_name(keys)}/{f}" for f in folder_names(spark, f"{change}/keys", columns)}
