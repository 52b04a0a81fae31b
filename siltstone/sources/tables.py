"""Parquet tables and generated series."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siltstone.functions.cleaning import PARTITION_COLUMNS
from siltstone.functions.timekeys import in_days
from siltstone.sources.commits import ready
from siltstone.sources.files import exists


# A table whose schema has grown keeps it beside its folders; readers skip names that begin so.
SCHEMA_FOLDER = "_schema"


def declared_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema a table has grown to, or None while all its files have the same."""
    if not exists(spark, f"{path}/{SCHEMA_FOLDER}"):
        return None
    row = spark.read.text(f"{path}/{SCHEMA_FOLDER}").first()
    return None if row is None else T.StructType.fromJson(json.loads(row[0]))


def schema_text(schema: T.StructType) -> dict[str, str]:
    """What a commit keeps so that older and newer folders are read under one schema."""
    return {f"{SCHEMA_FOLDER}/schema.json": schema.json()}


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Read a layer table; a day range prunes its ``_year/_month/_day`` folders.

    What a stopped writer has left undone is made good first.
    """
    ready(spark, path)
    schema = declared_schema(spark, path)
    df = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    if first is not None or last is not None:
        df = df.where(in_days(PARTITION_COLUMNS, first, last))
    return df.select(*columns) if columns else df


def read_table_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there yet."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        # No folder, or one without a data file, as an interrupted first write leaves it.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def days(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day of an inclusive range, in column ``date``."""
    count = (last - first).days + 1
    return spark.range(count).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))


def minutes(spark: SparkSession) -> DataFrame:
    """One row per minute of the day, in column ``id``."""
    return spark.range(24 * 60)
