"""Session set-up and the shared folder that intermediate tables are cut to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
INITIAL_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# On a cluster a shuffle starts with many partitions, which adaptive execution
# merges to their advised size: it never makes more than it started with.
INITIAL_PARTITIONS = 8_192

# Chosen for jobs that write day-partitioned facts: AQE sizes the shuffles and
# splits skewed ones, so no job carries a partition count of its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # The default, INT96, carries no statistics, so time ranges could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ANSI mode stays at Spark's default."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local") and spark.conf.get(INITIAL_CONF, None) is None:
        spark.conf.set(INITIAL_CONF, str(INITIAL_PARTITIONS))
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Set on a session made elsewhere what results and files depend on."""
    for key in ("spark.sql.session.timeZone", "spark.sql.parquet.outputTimestampType"):
        spark.conf.set(key, DEFAULTS[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can read, as the cluster names it.

    Only a local session, where driver and executors share one machine, may
    fall back to a fresh temporary folder.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set(CHECKPOINT_CONF, path)
    return path.rstrip("/")


WIDE_OPTIONS = {"parquet.enable.dictionary": "false"}

# A job's shuffles are deleted when it ends; otherwise they stay until the driver happens
# to collect garbage, and those of all jobs of a run are on disk at once.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Paths handed out in each open scope, innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Settings of a session for the work inside; then they are as before."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside when the work is done, failed or not, and each job's shuffles with it.

    To be put around work that ends with its result committed elsewhere; a frame
    that still reads an intermediate table must not leave the scope.
    """
    from siltstone.sources.files import remove

    _SCOPES.append([])
    try:
        with settings(spark, FREED):
            yield
    finally:
        remove(spark, _SCOPES.pop())


def materialise(df: DataFrame, label: str, wide: bool = False) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read the table back.

    The written table outlives the executors that made it, is not recomputed
    when read twice, and gives the planner real sizes for what follows.  Of
    ``wide`` records no dictionaries of values are made: that takes half the
    time to write, for a third more bytes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with settings(spark, FREED):
        df.write.options(**WIDE_OPTIONS if wide else {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
