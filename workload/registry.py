"""Where queries and their SQL twins are registered."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siltstone.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Processing time of every audited row, so that reruns agree.
AT = "2024-02-01 00:00:00"


def plain_times(df: DataFrame) -> DataFrame:
    """Zoned timestamps as the plain ones the supplied tables use."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(run: Query) -> Query:
        @wraps(run)
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(run(configure(spark), sf_dir.rstrip("/")))

        QUERIES[run.__name__] = wrapped
        if sql is not None:
            ORACLES[run.__name__] = " ".join(sql.split("\n")).strip()
        return wrapped

    return register
