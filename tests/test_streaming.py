import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_layers import ARRIVAL, AT, LINE, STOP, feed, status

from siltstone import streaming
from siltstone.plans import dims, facts, silver
from siltstone.schemas import feed_schema
from siltstone.sources import feeds as raw
from siltstone.sources.tables import read_table
from siltstone.streaming.jobs import drop_copies

ARRIVALS = silver.TABLES["arrivals"]


def deliver(tmp_path, name, *records):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps({"_ingested_at": "2024-06-15T08:00:00Z", **r}) + "\n" for r in records))


def arrival(i, time, **extra):
    return {**ARRIVAL, "id": i, "timestamp": f"2024-06-15T{time}:00", **extra}


def stream(spark, tmp_path, name="arrivals"):
    return streaming.read_feed_stream(spark, str(tmp_path / "in"), feed_schema(name))


def test_landing_files_by_day(spark, tmp_path):
    deliver(tmp_path, "a", arrival("1", "08:00"), arrival("2", "08:00", _ingested_at="2024-06-16T00:00:01Z"))
    for _ in range(2):
        streaming.land_stream(stream(spark, tmp_path), str(tmp_path / "out"), str(tmp_path / "cp"), "_ingested_at")
    landed = raw.read_feed(spark, str(tmp_path / "out"), feed_schema("arrivals"))
    assert rows(landed, "id", "month", "day") == [("1", 6, 15), ("2", 6, 16)]


@pytest.mark.parametrize("salts", [0, 4])
def test_copies_and_late_rows(spark, tmp_path, salts):
    def run():
        out = streaming.silver_stream(ARRIVALS, stream(spark, tmp_path), "1 hour", AT, salts)
        streaming.write_available(out, str(tmp_path / "out"), str(tmp_path / f"cp{salts}"))
        return [x for (x,) in rows(read_table(spark, str(tmp_path / "out")), "id")]

    deliver(tmp_path, "a", arrival("1", "08:00"), arrival("1", "08:00"), arrival("2", "12:00"), arrival(None, "08:00"))
    assert run() == ["1", "2"]
    deliver(tmp_path, "b", arrival("2", "12:00"), arrival("3", "11:30"), arrival("late", "10:00"))
    assert run() == ["1", "2", "3"]


def test_copies_are_dropped_by_task_first(spark, tmp_path, capsys):
    deliver(tmp_path, "a", arrival("1", "08:00"))
    clean = ARRIVALS.clean(stream(spark, tmp_path)).withWatermark("timestamp", "1 hour")
    drop_copies(clean, ARRIVALS.keys).explain(extended=True)
    assert capsys.readouterr().out.count("DeduplicateWithinWatermark [id") >= 2


def test_stream_upsert_is_exact_and_repeatable(spark, tmp_path):
    path = str(tmp_path / "out")

    def run(state):
        out = silver.finish(ARRIVALS.clean(stream(spark, tmp_path)), ARRIVALS, AT)
        streaming.upsert_stream(out, path, str(tmp_path / state), ARRIVALS.keys, ARRIVALS.newest, filed_by_key=ARRIVALS.filed_by_key)
        return rows(read_table(spark, path), "id", "towards")

    deliver(tmp_path, "a", arrival("1", "08:00"), arrival("2", "12:00"))
    assert run("cp") == [("1", "Brixton"), ("2", "Brixton")]
    deliver(tmp_path, "b", arrival("1", "08:00", towards="Later", _ingested_at="2024-06-15T09:00:00Z"), arrival("late", "02:00"))
    expected = [("1", "Later"), ("2", "Brixton"), ("late", "Brixton")]
    assert run("cp") == expected
    assert run("replayed from the start") == expected


def test_stream_fact(spark, tmp_path):
    lines = silver.line_status(feed(spark, "line_status", {**LINE, "lineStatuses": [status(10)]}), AT)
    stops = silver.stoppoints(feed(spark, "stoppoints", STOP), AT)
    batch = silver.arrivals(feed(spark, "arrivals", ARRIVAL), AT)
    line, station = dims.dim_line(lines, at=AT), dims.dim_station(stops, batch, at=AT)
    deliver(tmp_path, "a", ARRIVAL, {**ARRIVAL, "id": "2", "lineId": "ghost"})
    arrivals = streaming.silver_stream(ARRIVALS, stream(spark, tmp_path), "1 hour", AT)
    fact = facts.fact_arrivals(arrivals, dims.dim_time(spark, AT), line, station, AT)
    streaming.write_available(fact, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = read_table(spark, str(tmp_path / "out"))
    assert rows(got, "arrival_id", "line_key", "station_key", "time_key") == [("1", 0, 0, 480), ("2", None, 0, 480)]
    assert set(got.columns) == set(facts.fact_arrivals(batch, dims.dim_time(spark, AT), line, station, AT).columns)


def test_large_dimension_in_a_stream(spark, tmp_path, monkeypatch):
    from siltstone.operators import starjoin

    monkeypatch.setattr(starjoin, "BROADCAST_ROWS", 0)
    deliver(tmp_path, "a", *(arrival(str(i), "08:00", lineId="victoria" if i % 2 else "ghost") for i in range(20)))
    dim = spark.createDataFrame([("victoria", 7)], "line_id string, line_key int")
    joined = starjoin.lookup_join(stream(spark, tmp_path), starjoin.Lookup(dim, "lineId", "line_id", ("line_key",)), ["id"])
    out = joined.select("id", "line_key", F.lit(1).alias("_day"))
    streaming.write_available(out, str(tmp_path / "out"), str(tmp_path / "cp"), ["_day"])
    assert rows(read_table(spark, str(tmp_path / "out")), "id", "line_key") == sorted(((str(i), 7 if i % 2 else None) for i in range(20)), key=repr)


def test_settled_rows_are_those_of_the_batch(spark, tmp_path):
    copies = [arrival("1", "08:00", towards=t, _ingested_at=f"2024-06-15T0{h}:00:00Z") for t, h in (("b", 9), ("a", 9), ("c", 8), (None, 9))]
    records = [*copies, arrival("2", "09:00", naptanId=None), arrival("3", "09:30"), arrival("3", "09:30"), arrival("open", "12:00")]

    def run():
        out = streaming.settled_stream(ARRIVALS, stream(spark, tmp_path), "1 hour", AT)
        streaming.write_available(out, str(tmp_path / "out"), str(tmp_path / "cp"))
        return read_table(spark, str(tmp_path / "out"))

    deliver(tmp_path, "a", *records)
    batch = silver.arrivals(feed(spark, "arrivals", *({"_ingested_at": "2024-06-15T08:00:00Z", **r} for r in records)), AT)
    made = run()
    assert made.columns == batch.columns
    assert rows(made) == rows(batch.where("id <> 'open'")) and made.where("id = '1'").first()["towards"] == "a"
    deliver(tmp_path, "b", arrival("late", "08:00"), arrival("next", "15:00"))
    assert rows(run(), "id") == [("1",), ("3",), ("open",)]
    with pytest.raises(ValueError):
        streaming.settled_stream(silver.TABLES["stoppoints"], stream(spark, tmp_path, "stoppoints"), "1 hour")


def test_facts_of_batches_repeat_heavy_members_only(spark, tmp_path, monkeypatch):
    from siltstone.operators import starjoin

    monkeypatch.setattr(starjoin, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(starjoin, "HEAVY_SHARE", 2)
    deliver(tmp_path, "a", *(arrival(str(i), "08:00", lineId="victoria" if i % 4 else f"ghost{i}") for i in range(20)))
    dim = spark.createDataFrame([("victoria", 7), ("unused", 8)], "line_id string, line_key int")
    counted = []
    salted = starjoin.salted_left_join

    def seen(fact, dim_, *args):
        counted.append({r["_heavy"] for r in args[-1].collect()})
        return salted(fact, dim_, *args)

    monkeypatch.setattr(starjoin, "salted_left_join", seen)

    def build(batch):
        joined = starjoin.lookup_join(batch, starjoin.Lookup(dim, "lineId", "line_id", ("line_key",)), ["id"])
        return joined.select("id", "timestamp", "line_key", "_ingested_at", F.lit(1).alias("_day"))

    arrivals = silver.finish(ARRIVALS.clean(stream(spark, tmp_path)), ARRIVALS, AT)
    for state in ("cp", "replayed"):
        streaming.fact_stream(arrivals, build, str(tmp_path / "out"), str(tmp_path / state), ("id", "timestamp"), ("_ingested_at",), ["_day"])
    want = sorted(((str(i), 7 if i % 4 else None) for i in range(20)), key=repr)
    assert rows(read_table(spark, str(tmp_path / "out")), "id", "line_key") == want
    assert counted == [{"victoria"}] * 2


def test_a_stream_sets_bad_lines_aside(spark, tmp_path):
    from siltstone.sources.commits import quarantined

    path = str(tmp_path / "out")
    deliver(tmp_path, "a", arrival("1", "08:00"), arrival("no line", "08:00", lineId=None))
    (tmp_path / "in" / "b.json").write_text('{"id": "cut\n')
    for _ in range(2):
        marked = streaming.read_feed_stream(spark, str(tmp_path / "in"), feed_schema("arrivals"), marked=True)
        streaming.routed_stream(ARRIVALS, path, marked, str(tmp_path / "cp"), AT)
    assert rows(read_table(spark, path), "id") == [("1",)]
    assert [r[0] for r in rows(quarantined(spark, path), "reason")] == ["incomplete", "unparsed"]
