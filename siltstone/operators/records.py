"""Message shaping: metadata, keys, key/value records, payload unwrapping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltstone.schemas import FINGERPRINTED, MESSAGE_KEYS, NO_KEY

INGEST_COLUMNS = ("_ingested_at", "_source", "_topic")


def with_metadata(df: DataFrame, source: str, topic: str, ingested_at: str | Column) -> DataFrame:
    """Add ingest time, source and topic; the payload's own columns are untouched."""
    at = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    return df.withColumns(dict(zip(INGEST_COLUMNS, (at, F.lit(source), F.lit(topic)))))


def payload_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in INGEST_COLUMNS]


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-1 of the record as JSON with its fields in name order."""
    return F.sha1(F.to_json(F.struct(*sorted(columns))))


def first_filled(columns: Sequence[str]) -> Column:
    """First of ``columns`` that is neither null nor empty, as text."""
    return F.coalesce(*(F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns))


def message_key(df: DataFrame, feed: str) -> Column:
    """Key of each record of a feed.

    Preferred columns the frame lacks are passed over.  What follows them is a
    fingerprint of the payload or the word for "unknown", by feed; air-quality
    records are keyed by their UTC ingest date.
    """
    if feed == "air_quality":
        return F.date_format(F.try_to_timestamp(F.col("_ingested_at")), "yyyy-MM-dd")
    present = [c for c in MESSAGE_KEYS[feed] if c in df.columns]
    last = fingerprint(payload_columns(df)) if feed in FINGERPRINTED else F.lit(NO_KEY)
    return F.coalesce(first_filled(present), last) if present else last


def to_records(df: DataFrame, key: Column) -> DataFrame:
    """``(key, value)`` rows, value being the whole row as JSON."""
    return df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def unwrap_payload(
    df: DataFrame, item: T.StructType, payload: str = "value", wrapper: str | None = None
) -> DataFrame:
    """One row per record of a response body.

    A list gives its elements, an object one row, ``{wrapper: [...]}`` the inner
    list, anything else nothing.  Other columns are repeated.
    """
    body = F.col(payload)
    if wrapper:
        # An object that has the wrapper field is always the envelope, even
        # when the list in it is empty.
        body = F.when(
            F.ltrim(body).startswith("{"), F.coalesce(F.get_json_object(body, f"$.{wrapper}"), F.lit("[]"))
        ).otherwise(body)
    kept = [c for c in df.columns if c != payload]
    items = F.from_json(body, T.ArrayType(item))
    rows = df.select(*kept, F.explode(items).alias("_item"))
    return rows.where(F.col("_item").isNotNull()).select(*kept, "_item.*")


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Rows of all batches, matched by column name; columns a batch lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
