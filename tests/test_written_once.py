"""Rows that are taken in go to their table without being written out on the way."""

from __future__ import annotations

import json

from conftest import rows
from siltstone import streaming
from siltstone.operators import merge
from siltstone.plans import refresh, silver
from siltstone.schemas import feed_schema
from siltstone.sources.feeds import read_feed
from siltstone.sources.tables import read_table

AT = "2024-06-16 00:00:00"
RECORD = {"naptanId": "S1", "lineId": "L", "timestamp": "2024-06-15T08:00:00Z", "_ingested_at": "2024-06-15T08:00:10Z"}


def deliver(tmp_path, name, *records, day=15):
    folder = tmp_path / "bronze" / "year=2024" / "month=06" / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps({**RECORD, **r}) + "\n" for r in records))


def labels_of(monkeypatch, module):
    """The labels of the intermediate tables that ``module`` writes from now on."""
    written, materialise = [], module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, label, **how: written.append(label) or materialise(df, label, **how))
    return written


def test_new_records_meet_the_table_in_one_shuffle(spark, tmp_path, monkeypatch):
    written = labels_of(monkeypatch, merge)
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    newer = "2024-06-15T09:00:00Z"
    deliver(tmp_path, "a", {"id": "1", "towards": "b"}, {"id": "1", "towards": "c"}, {"id": "2", "towards": "old"}, {"id": "0", "timestamp": None})
    changed = [refresh.take_in(spark, "arrivals", bronze, path, AT)]
    deliver(tmp_path, "b", {"id": "1", "towards": "a"}, {"id": "2", "towards": "new", "_ingested_at": newer}, {"id": "0", "timestamp": None},
            {"id": "3", "timestamp": "2024-06-16T08:00:00Z"}, {"id": "3", "timestamp": "2024-06-16T08:00:00Z"}, {"id": "no line", "lineId": None})
    changed.append(refresh.take_in(spark, "arrivals", bronze, path, AT))
    assert written == []
    whole = silver.arrivals(read_feed(spark, bronze, feed_schema("arrivals")), AT)
    made = read_table(spark, path)
    assert rows(made, *whole.columns) == rows(whole)
    assert rows(made, "id", "towards") == [("0", None), ("1", "a"), ("2", "new"), ("3", None)]
    none = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in ("_year", "_month", "_day"))
    first = {"_year=2024/_month=6/_day=15", none}
    assert changed == [first, first | {"_year=2024/_month=6/_day=16"}]


def test_a_source_read_from_its_own_table_is_written_first(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    start = spark.createDataFrame([(1, 1, 15), (2, 1, 16)], "id int, version int, _day int")
    merge.upsert_table(path, start, ["id", "_day"], ["version"], ["_day"], filed_by_key=True)
    written = labels_of(monkeypatch, merge)
    source = read_table(spark, path).selectExpr("id", "version + 1 as version", "_day")
    merge.upsert_table(path, source, ["id", "_day"], ["version"], ["_day"], filed_by_key=True)
    assert written == ["upsert-source"]
    assert rows(read_table(spark, path), "id", "version") == [(1, 2), (2, 2)]


def test_work_on_a_batch_is_as_adaptive_as_the_session(spark, tmp_path, monkeypatch):
    written, seen = labels_of(monkeypatch, merge), []
    deliver(tmp_path, "a", {"id": "1"}, {"id": "2"}, {"id": "next", "timestamp": "2024-06-15T12:00:00Z"})

    def build(batch):
        seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return batch

    stream = streaming.read_feed_stream(spark, str(tmp_path / "bronze"), feed_schema("arrivals"))
    settled = streaming.settled_stream(silver.TABLES["arrivals"], stream, "1 hour", AT)
    path = str(tmp_path / "fact")
    streaming.fact_stream(settled, build, path, str(tmp_path / "cp"), ("id", "timestamp"), ("_ingested_at",))
    assert set(seen) == {"true"} and written == []
    assert rows(read_table(spark, path), "id") == [("1",), ("2",)]
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
