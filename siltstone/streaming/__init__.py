"""Structured Streaming twins of the batch steps."""

from siltstone.streaming.jobs import (
    fact_stream,
    land_stream,
    read_feed_stream,
    read_topic_stream,
    routed_stream,
    settled_stream,
    silver_stream,
    upsert_stream,
    write_available,
)

__all__ = [
    "fact_stream", "land_stream", "read_feed_stream", "read_topic_stream", "routed_stream", "settled_stream", "silver_stream",
    "upsert_stream", "write_available",
]
