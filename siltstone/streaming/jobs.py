"""Streams from landed files or a topic to raw, cleaned and fact tables.

State is bounded by the watermark: copies that arrive further apart than the
delay, and rows older than the watermark, are left to ``plans.refresh.backfill``.
The facts need no streaming twin; ``plans.facts`` accepts a streaming frame.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from siltstone.functions.cleaning import PARTITION_COLUMNS
from siltstone.operators.dedup import earliest_order, survivor_columns
from siltstone.operators.merge import Settled, upsert_table
from siltstone.operators.starjoin import STREAM_SALTS
from siltstone.plans.silver import INGESTED, PROCESSED, SilverTable, finish, route
from siltstone.session import materialise, scratch_scope, settings
from siltstone.sources.commits import BAD
from siltstone.sources.feeds import CORRUPT, DAY_FOLDERS, FILE, LANDED_OPTIONS, parse_lines, with_day_folders

EVENT = "_event_time"

ADAPTIVE = "spark.sql.adaptive.enabled"

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "spark.sql.streaming.stateStore.rocksdb."
# Spark's default store holds all state in the executors' heaps, so a backlog that waits for
# its watermark has to fit there.  This one keeps it on their disks, and all its instances in
# an executor share so many MB.  Rows are not counted, which would look up every key written.
STATE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKS}boundedMemoryUsage": "true",
    f"{_ROCKS}maxMemoryUsageMB": "200",
    f"{_ROCKS}trackTotalNumberOfRows": "false",
    f"{_ROCKS}allowFAllocate": "false",
    f"{_ROCKS}compression": "zstd",
}


def started(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Run what is available now, and wait for it.

    State is kept as ``STATE`` says unless the session names a store of its own; a
    stream that goes on from a checkpoint keeps the store it began with.
    """
    with settings(spark, STATE if spark.conf.get(PROVIDER, None) is None else {}):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_feed_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_trigger: int | None = None, marked: bool = False
) -> DataFrame:
    """Files that appear under ``path`` as a stream; ``marked`` rows keep their text where it did not parse, and their file."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if marked else schema
    reader = spark.readStream.format(fmt).schema(full).option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.load(path)
    return stream.withColumn(FILE, F.col("_metadata.file_path")) if marked else stream


def parse_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of a frame of ``(key, value)`` messages; text that does not parse is kept in ``_corrupt_record``.

    ``split_lines`` parts the rows, for a quarantine of their own.
    """
    return parse_lines(messages.select(F.col("value").cast("string").alias("value")), schema)


def read_topic_stream(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, per_trigger: int | None = None
) -> DataFrame:
    """A message topic as a stream of parsed messages; needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return parse_messages(reader.load(), schema)


def write_available(
    df: DataFrame, path: str, checkpoint: str, columns: Sequence[str] = PARTITION_COLUMNS, fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Write what is available now to a partitioned file sink and wait for it."""
    writer = (
        df.writeStream.format(fmt)
        .options(**(options or {}))
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*columns)
        .outputMode("append")
    )
    return started(writer, df.sparkSession)


def land_stream(df: DataFrame, path: str, checkpoint: str, time_column: str) -> StreamingQuery:
    """Land records as compressed JSON under day folders."""
    return write_available(with_day_folders(df, time_column), path, checkpoint, DAY_FOLDERS, fmt="json", options=LANDED_OPTIONS)


def drop_copies(stream: DataFrame, keys: Sequence[str], salts: int = STREAM_SALTS) -> DataFrame:
    """Keep one row per key within the watermark the stream carries.

    A first pass drops copies among the rows of the same input tasks, so that a
    key with a large share of the rows is not handled by one task alone; the
    second pass sees at most ``salts`` rows of a key per batch.  With
    ``salts=0`` there is only the second pass, which needs half the state.
    """
    if salts:
        salted = stream.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        stream = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return stream.dropDuplicatesWithinWatermark(list(keys))


def silver_stream(
    table: SilverTable, stream: DataFrame, delay: str, at: str | None = None, salts: int = STREAM_SALTS
) -> DataFrame:
    """Clean a feed as it arrives, dropping copies of a key within the watermark."""
    clean = table.clean(stream).withWatermark(table.time, delay)
    return finish(drop_copies(clean, table.keys, salts), table, at)


def settled_stream(table: SilverTable, stream: DataFrame, delay: str, at: str | None = None) -> DataFrame:
    """Clean a feed and emit, for each key, the very row that the batch table keeps.

    A key is emitted once no more copies can come, when its time is ``delay``
    older than the newest seen; until then its best row is state, one per key.
    Copies meet in a partial aggregate before the shuffle, so a key with any
    number of them sends one row per task.  Rows without a time of their own go by
    that of their ingestion.  The key must hold the time: other tables are fed by
    ``upsert_stream``.
    """
    if not table.filed_by_key:
        raise ValueError("only a key that holds its time can be closed; use upsert_stream")
    clean = table.clean(stream)
    # The group's own time column carries the watermark, so it cannot be null.
    timed = clean.withColumn(EVENT, F.coalesce(table.time, INGESTED, F.timestamp_seconds(F.lit(0)))).withWatermark(EVENT, delay)
    least = F.min(earliest_order(clean, table.keys, table.newest, table.lowest)).alias("_least")
    closed = timed.groupBy(EVENT, *table.keys).agg(least)
    return finish(closed.select(*survivor_columns("_least", clean, table.keys, table.newest)), table, at)


def each_batch(df: DataFrame, checkpoint: str, work: Callable[[DataFrame], None]) -> StreamingQuery:
    """Do ``work`` with each micro-batch of what is available now, and wait for it.

    A stream's own plan is not adaptive, since its state stays in its partitions.
    What is done with a batch is as adaptive as the session: its shuffles fit the
    rows at hand, and rows are gathered by folder before they are written.
    """
    adaptive = df.sparkSession.conf.get(ADAPTIVE)

    def run(batch: DataFrame, _batch_id: int) -> None:
        with scratch_scope(batch.sparkSession), settings(batch.sparkSession, {ADAPTIVE: adaptive}):
            work(batch)

    return started(df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), df.sparkSession)


def fact_stream(
    rows: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, keys: Sequence[str],
    newest: Sequence[str], columns: Sequence[str] = PARTITION_COLUMNS,
) -> StreamingQuery:
    """Turn each micro-batch of cleaned rows into facts and merge these; a batch that is replayed changes nothing.

    Inside a batch ``build`` joins a bounded frame: sizes are measured and heavy
    keys counted, so that a large dimension is neither broadcast nor repeated for
    keys that are not heavy in this batch.
    """
    def work(batch: DataFrame) -> None:
        # Written out, since its keys are counted before it is joined.
        # So are the facts, so that the shuffles of their joins are gone before those of the merge.
        made = materialise(build(materialise(batch, "micro-batch", wide=True)), "facts")
        upsert_table(path, made, keys, newest, columns, filed_by_key=True)

    return each_batch(rows, checkpoint, work)


def routed_stream(
    table: SilverTable, path: str, marked: DataFrame, checkpoint: str, at: str | None = None
) -> StreamingQuery:
    """Merge a feed's files as they appear, and set aside the lines that give no row, from one scan and in one commit.

    ``marked`` is a stream that ``read_feed_stream(..., marked=True)`` gave.
    """

    def work(batch: DataFrame) -> None:
        good, bad = route(table, materialise(batch, "micro-batch", wide=True))
        bad = materialise(bad, "bad")
        upsert_table(
            path, finish(table.clean(good), table, at), table.keys, table.newest, filed_by_key=table.filed_by_key,
            settled=Settled(table.lowest, (PROCESSED,)), beside={} if bad.isEmpty() else {BAD: bad},
        )

    return each_batch(marked, checkpoint, work)


def upsert_stream(
    df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest: Sequence[str],
    columns: Sequence[str] = PARTITION_COLUMNS, filed_by_key: bool = False,
) -> StreamingQuery:
    """Merge each micro-batch into a table; a batch that is replayed changes nothing.

    The file sink keeps a log of its own files and readers trust only that, so
    a table that batch jobs also write, a backfill for one, is fed this way.
    """

    def work(batch: DataFrame) -> None:
        upsert_table(path, batch, keys, newest, columns, filed_by_key)

    return each_batch(df, checkpoint, work)
