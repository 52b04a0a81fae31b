"""State of a stream: kept on disk in bounded memory, with the store that a checkpoint began with."""

from __future__ import annotations

import json

from conftest import rows
from siltstone import streaming
from siltstone.plans import silver
from siltstone.schemas import feed_schema
from siltstone.sources.tables import read_table
from siltstone.streaming import jobs

AT = "2024-06-16 00:00:00"
ARRIVALS = silver.TABLES["arrivals"]
HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def deliver(tmp_path, name, *records):
    (tmp_path / "in").mkdir(exist_ok=True)
    base = {"naptanId": "S1", "lineId": "L", "_ingested_at": "2024-06-15T08:00:10Z"}
    (tmp_path / "in" / f"{name}.json").write_text("".join(json.dumps({**base, "id": i, "timestamp": f"2024-06-15T{t}:00Z", "towards": to}) + "\n" for i, t, to in records))


def settled(spark, tmp_path):
    stream = streaming.read_feed_stream(spark, str(tmp_path / "in"), feed_schema("arrivals"))
    return streaming.settled_stream(ARRIVALS, stream, "1 hour", AT)


def metrics(query):
    return {name for progress in query.recentProgress for state in progress["stateOperators"] for name in state["customMetrics"]}


def run(spark, tmp_path, path="out"):
    query = streaming.write_available(settled(spark, tmp_path), str(tmp_path / path), str(tmp_path / f"{path}-state"))
    return query, rows(read_table(spark, str(tmp_path / path)), "id", "towards")


def test_a_backlog_is_not_kept_in_the_heap(spark, tmp_path):
    deliver(tmp_path, "a", ("1", "08:00", "b"), ("1", "08:00", "a"), ("2", "08:30", "c"), ("open", "12:00", "d"))
    query, made = run(spark, tmp_path)
    assert made == [("1", "a"), ("2", "c")]
    assert any(name.startswith("rocksdb") for name in metrics(query))
    assert not any(spark.conf.get(key, None) == value for key, value in jobs.STATE.items() if key == jobs.PROVIDER)
    deliver(tmp_path, "b", ("late", "08:00", "e"), ("next", "15:00", "f"))
    assert run(spark, tmp_path)[1] == [("1", "a"), ("2", "c"), ("open", "d")]


def test_facts_are_written_before_they_are_merged(spark, tmp_path, monkeypatch):
    written, write = [], jobs.materialise
    monkeypatch.setattr(jobs, "materialise", lambda df, label, **how: written.append(label) or write(df, label, **how))
    deliver(tmp_path, "a", ("1", "08:00", "b"), ("open", "12:00", "d"))
    path = str(tmp_path / "fact")
    for state in ("first", "replayed"):
        query = streaming.fact_stream(settled(spark, tmp_path), lambda batch: batch, path, str(tmp_path / state), ARRIVALS.keys, ARRIVALS.newest)
        assert any(name.startswith("rocksdb") for name in metrics(query))
    assert rows(read_table(spark, path), "id", "towards") == [("1", "b")]
    assert written[:2] == ["micro-batch", "facts"] and set(written) == {"micro-batch", "facts"}


def test_a_stream_goes_on_with_the_store_it_began_with(spark, tmp_path):
    deliver(tmp_path, "a", ("1", "08:00", "b"), ("open", "12:00", "d"))
    spark.conf.set(jobs.PROVIDER, HEAP)
    try:
        query, made = run(spark, tmp_path)
    finally:
        spark.conf.unset(jobs.PROVIDER)
    assert made == [("1", "b")] and not any(name.startswith("rocksdb") for name in metrics(query))
    deliver(tmp_path, "b", ("next", "15:00", "f"))
    query, made = run(spark, tmp_path)
    assert made == [("1", "b"), ("open", "d")] and not any(name.startswith("rocksdb") for name in metrics(query))
