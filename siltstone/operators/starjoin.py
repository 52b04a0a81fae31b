"""Left joins of a fact to its dimensions; unmatched fact rows keep null attributes.

A dimension is broadcast only when its size is proven (``row_bound``) or has
been measured.  Beyond that the join shuffles, and the keys that hold a large
share of the fact are spread over many tasks by a salt.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltstone.session import INITIAL_CONF

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is heavy when it holds more than 1/HEAVY_SHARE of the rows, or than half
# a shuffle partition's share where there are more partitions.  So no key fills a
# task, and there are fewer heavy keys than that number whatever the fact's size.
HEAVY_SHARE = 1_000
# Pieces are hashed to partitions, so they are cut finer than one partition's
# worth of rows: several small ones meet in a task without overfilling it.
PIECES_PER_PARTITION = 8
STREAM_SALTS = 32


@dataclass(frozen=True)
class Lookup:
    """One dimension of a star: ``fact_key = dim_key`` brings in ``take``.

    The dimension must be unique on ``dim_key``.  ``row_bound`` is the number of
    rows it can have by construction, where there is such a number.
    """

    table: DataFrame
    fact_key: str
    dim_key: str
    take: tuple[str, ...]
    row_bound: int | None = None


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and estimated bytes of a narrow table, in one aggregate over it."""
    fixed = 0
    variable = []
    for field in df.schema.fields:
        fixed += 16
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            variable.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            variable.append(F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)))
    width: Column = reduce(lambda a, b: a + b, variable, F.lit(fixed)).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def fits_broadcast(df: DataFrame, row_bound: int | None = None) -> bool:
    """Whether a narrow table may be sent to every executor."""
    if row_bound is not None:
        return row_bound <= BROADCAST_ROWS
    rows, size = measured_size(df)
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def shuffle_partitions(spark) -> int:
    """Partitions a shuffle starts with."""
    return int(spark.conf.get(INITIAL_CONF, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(fact: DataFrame, key: str, share: int | None = None) -> DataFrame:
    """Keys above 1/``share`` of the rows with the number of pieces to cut each into.

    Counts are combined before the shuffle, and what comes back to the driver
    is fewer than ``share`` rows.
    """
    spark = fact.sparkSession
    partitions = shuffle_partitions(spark)
    share = share or max(HEAVY_SHARE, 2 * partitions)
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    heavy = counts.withColumn("_share", F.col("_rows") / total).where(F.col("_share") * share > 1)
    pieces = F.greatest(F.lit(2), F.ceil(F.col("_share") * partitions * PIECES_PER_PARTITION)).cast("int")
    rows = heavy.select(F.col(key).alias("_heavy"), pieces.alias("_pieces")).collect()
    schema = T.StructType([T.StructField("_heavy", fact.schema[key].dataType), T.StructField("_pieces", T.IntegerType())])
    return spark.createDataFrame(rows, schema)


def _attach(fact: DataFrame, dim: DataFrame, condition: Column) -> DataFrame:
    return fact.join(dim, condition, "left")


def salted_left_join(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, grain: Sequence[str], pieces: DataFrame
) -> DataFrame:
    """Left join whose heavy keys are cut by a hash of the fact's own grain.

    The matching dimension rows are repeated once per piece, all others once.
    Rows without a key match nothing and are spread like a heavy key.
    """
    hashed = F.xxhash64(*grain)
    spread = F.broadcast(pieces)
    cut = fact.join(spread, F.col(fact_key).eqNullSafe(F.col("_heavy")), "left").withColumn(
        "_salt", F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(F.pmod(hashed, F.col("_pieces")).cast("int"))
    ).drop("_heavy", "_pieces")
    copies = dim.join(spread, F.col(dim_key).eqNullSafe(F.col("_heavy")), "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    ).drop("_heavy", "_pieces")
    on = (F.col(fact_key) == F.col(dim_key)) & (F.col("_salt") == F.col("_piece"))
    return _attach(cut, copies, on).drop("_salt", "_piece")


def lookup_join(fact: DataFrame, lookup: Lookup, grain: Sequence[str], bare: DataFrame | None = None) -> DataFrame:
    """Add the attributes of one dimension to the fact, keeping every fact row once.

    ``bare`` is the fact before any join, where its keys can be counted without
    running the joins before this one.
    """
    own = "_dim_key"
    dim = lookup.table.select(F.col(lookup.dim_key).alias(own), *(c for c in lookup.take))
    if fits_broadcast(dim, lookup.row_bound):
        joined = _attach(fact, F.broadcast(dim), F.col(lookup.fact_key) == F.col(own))
    elif fact.isStreaming:
        # A stream cannot be counted beforehand, so all of its keys are cut alike.
        keys = dim.select(F.col(own), F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1))).alias("_piece"), *lookup.take)
        salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*grain), F.lit(STREAM_SALTS)).cast("int"))
        on = (F.col(lookup.fact_key) == F.col(own)) & (F.col("_salt") == F.col("_piece"))
        joined = _attach(salted, keys, on).drop("_salt", "_piece")
    else:
        joined = salted_left_join(fact, dim, lookup.fact_key, own, grain, heavy_keys(bare or fact, lookup.fact_key))
    return joined.drop(own)


def star_join(fact: DataFrame, lookups: Sequence[Lookup], grain: Sequence[str]) -> DataFrame:
    """Join a fact to each of its dimensions in turn.

    ``grain`` names the columns that identify a fact row.
    """
    return reduce(lambda df, lookup: lookup_join(df, lookup, grain, fact), lookups, fact)
