"""Feeds to cleaned tables to the star, on literal payloads."""

import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from siltstone.operators.quality import Expectations, health_report, quality_report
from siltstone.plans import dims, facts, refresh, silver, views
from siltstone.schemas import feed_schema
from siltstone.sources import feeds as raw
from siltstone.sources.sinks import append_new, observed, write_dimension, write_partitioned
from siltstone.sources.tables import read_table, read_table_if_any

AT = "2024-07-01 00:00:00"
POLL = "2024-06-15T08:00:00.123456+00:00"


def feed(spark, name, *records):
    """Records as JSON lines read with the feed's schema, as a landed file would be."""
    lines = [json.dumps({"_ingested_at": POLL, "_source": "s", "_topic": "t", **r}) for r in records]
    parsed = raw.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), feed_schema(name))
    return raw.split_lines(parsed)[0]


ARRIVAL = {
    "id": "1", "vehicleId": "V", "naptanId": "N1", "stationName": " Oxford Circus ", "lineId": "victoria", "lineName": "Victoria",
    "platformName": "P1", "direction": " Inbound ", "bearing": "90", "destinationNaptanId": "", "destinationName": "Brixton ",
    "timestamp": "2024-06-15T08:00:00", "timeToStation": 90, "currentLocation": "At ", "towards": "Brixton",
    "expectedArrival": "2024-06-15T08:01:30Z", "timeToLive": "soon", "modeName": "tube",
}


def test_arrivals(spark):
    bronze = feed(
        spark, "arrivals", ARRIVAL, {**ARRIVAL, "towards": "Later", "_ingested_at": "2024-06-15T08:00:30Z"},
        {**ARRIVAL, "id": None}, {**ARRIVAL, "naptanId": None}, {**ARRIVAL, "lineId": None},
        {**ARRIVAL, "timestamp": "2024-06-16T00:00:00"}, {**ARRIVAL, "id": "2", "timestamp": "whenever"},
    )
    out = silver.arrivals(bronze, AT)
    assert "_source" not in out.columns and "bearing" not in out.columns and out.columns[-1] == "_day"
    assert rows(out, "id", "towards", "direction", "stationName", "operationType", "timeToLive", "_day") == [
        ("1", "Brixton", "inbound", "Oxford Circus", None, None, 16),
        ("1", "Later", "inbound", "Oxford Circus", None, None, 15),
        ("2", "Brixton", "inbound", "Oxford Circus", None, None, None),
    ]
    assert out.where("id = '1' and _day = 15").select(F.col("expectedArrival").cast("timestamp_ntz")).first()[0] == datetime(2024, 6, 15, 8, 1, 30)


LINE = {"id": "victoria", "name": " Victoria ", "modeName": "Tube "}


def status(code, reason=None):
    return {"id": 0, "statusSeverity": code, "statusSeverityDescription": f"S{code}", "reason": reason}


def line_feed(spark):
    return feed(
        spark, "line_status", {**LINE, "lineStatuses": [status(6, "late"), status(10), status(6, "late")]},
        {**LINE, "id": "bus", "modeName": "bus", "lineStatuses": []}, {**LINE, "id": "dlr", "modeName": "dlr"},
        {**LINE, "id": None, "lineStatuses": [status(1)]},
    )


def test_line_status_keeps_each_status(spark):
    out = silver.line_status(line_feed(spark), AT)
    assert rows(out, "id", "name", "modeName", "statusSeverity", "reason") == [
        ("bus", "Victoria", "bus", None, None), ("dlr", "Victoria", "dlr", None, None),
        ("victoria", "Victoria", "tube", 10, None), ("victoria", "Victoria", "tube", 6, "late"),
    ]
    per_poll = silver.line_status(line_feed(spark), AT, keys=("id", "_ingested_at"))
    assert rows(per_poll, "id", "statusSeverity") == [("bus", None), ("dlr", None), ("victoria", 6)]


def test_bikepoints(spark):
    properties = [{"key": "NbBikes", "value": "5"}, {"key": "NbBikes", "value": "9"}, {"key": "NbDocks", "value": "x"}, {"key": "Locked", "value": "false"}]
    station = {"id": "B1", "commonName": "A", "placeType": "BikePoint", "lat": 51.5, "lon": -0.1}
    out = silver.bikepoints(feed(spark, "bikepoints", {**station, "additionalProperties": properties}, {**station, "id": "B2", "additionalProperties": []}, {**station, "id": None}), AT)
    assert rows(out, "id", "lat", "nbbikes", "nbdocks", "locked", "installed", "_month") == [
        ("B1", 51.5, 5, None, False, None, 6), ("B2", 51.5, None, None, None, None, 6),
    ]


STOP = {"naptanId": "N1", "commonName": "Oxford", "modes": ["tube", "bus"], "lat": 51.5, "lon": -0.1}
ZONE = [{"key": "Zone", "value": "2/3"}, {"key": "WiFi", "value": "Yes"}]


def test_stoppoints(spark):
    out = silver.stoppoints(feed(
        spark, "stoppoints", {**STOP, "commonName": "Old", "_ingested_at": "2024-06-14T00:00:00Z"},
        {**STOP, "status": True, "additionalProperties": ZONE}, {**STOP, "id": "I2", "modes": None}, {"commonName": "nameless"},
    ), AT)
    assert rows(out, "id", "naptanId", "commonName", "status", "zone", "wifi", "modes") == [
        ("I2", "N1", "Oxford", None, None, None, None), ("N1", "N1", "Oxford", True, "2/3", "Yes", "tube,bus"),
    ]


def test_air_quality(spark):
    def forecast(kind, text):
        return {"forecastType": kind, "forecastID": "F1", "fromDate": "2024-06-15T00:00:00Z", "nO2Band": "Low", "forecastText": text}

    bronze = feed(
        spark, "air_quality", {"updatePeriod": "h", "currentForecast": [forecast("Current", "a&lt;br/&gt;b"), forecast("Future", None)]},
        {"updatePeriod": "h", "currentForecast": []}, {"updatePeriod": "h"},
    )
    assert rows(silver.air_quality(bronze, AT), "forecastType", "forecastId", "no2Band", "forecastText") == [
        ("Current", "F1", "Low", "a b"), ("Future", "F1", "Low", None),
    ]
    assert rows(silver.air_quality(bronze, AT, decode=False), "forecastText") == [("abr/b",), (None,)]


def test_accidents(spark):
    record = {"id": 1, "date": "2019-06-15T08:00:00Z", "severity": " Slight", "borough": "Camden ", "lat": 51.5, "lon": -0.1}
    out = silver.accidents(feed(
        spark, "accidents", {**record, "vehicles": [{"type": "Car"}, {"type": None}, {"type": "Bus"}], "casualties": [{"severity": "Fatal"}, {"severity": "slight"}]},
        {**record, "id": 2, "vehicles": [], "casualties": []}, {**record, "id": 3}, {**record, "id": None},
    ), AT)
    picked = rows(out, "id", "severity", "borough", "vehicle_types", "casualties_total", "casualties_fatal", "casualties_serious", "casualties_slight", "_year")
    assert picked == [
        (1, "slight", "Camden", "Car, Bus", 2, 1, 0, 1, 2019), (2, "slight", "Camden", "", 0, 0, 0, 0, 2019),
        (3, "slight", "Camden", None, 0, 0, 0, 0, 2019),
    ]


def test_dim_date(spark):
    holidays = spark.createDataFrame([(date(2024, 12, 25),)], "date date")
    out = dims.dim_date(spark, date(2024, 3, 1), date(2025, 2, 1), holidays, AT)
    assert out.count() == 731 and out.select("date_key").distinct().count() == 731
    row = out.where("date_key = 20241230").first()
    assert (row["week_of_year"], row["day_name"], row["day_of_week"], row["quarter_name"], row["month_short"], row["is_weekend"]) == (1, "Monday", 2, "Q4", "Dec", False)
    assert rows(out.where("is_holiday"), "date_key") == [(20241225,)]
    assert rows(out.agg(F.min("date"), F.max("date"))) == [(date(2024, 1, 1), date(2025, 12, 31))]


def test_dim_time(spark):
    out = dims.dim_time(spark, AT)
    assert out.count() == 1440 and "id" not in out.columns
    assert rows(out.where("time_key in (0, 425, 1439)"), "time_key", "time_str", "period_of_day", "is_peak_hour") == [
        (0, "00:00", "Night", False), (1439, "23:59", "Late Night", False), (425, "07:05", "Early Morning", True),
    ]


def test_dimensions(spark):
    lines = silver.line_status(line_feed(spark), AT)
    assert rows(dims.dim_line(lines, at=AT), "line_id", "line_color", "is_tube", "is_bus", "is_overground", "line_key") == [
        ("bus", "#E1251B", False, True, False, 0), ("dlr", "#00A4A7", False, False, False, 1), ("victoria", "#0098D4", True, False, False, 2),
    ]
    assert rows(dims.dim_disruption(lines, at=AT), "severity_code", "severity_category", "is_good_service", "is_disrupted", "disruption_key") == [
        (10, "Normal", True, False, 2), (6, "Minor", False, True, 1), (None, "Unknown", None, None, 0),
    ]
    stops = silver.stoppoints(feed(
        spark, "stoppoints", {**STOP, "additionalProperties": ZONE}, {**STOP, "naptanId": "N2", "additionalProperties": [{"key": "Zone", "value": "1"}]},
        {**STOP, "naptanId": "N3"},
    ), AT)
    arrivals = silver.arrivals(feed(spark, "arrivals", ARRIVAL, {**ARRIVAL, "id": "2", "stationName": "Newer", "timestamp": "2024-06-16T08:00:00"}), AT)
    assert rows(dims.dim_station(stops, arrivals, at=AT), "naptan_id", "display_name", "zone_primary", "zone_secondary", "has_wifi", "station_key") == [
        ("N1", "Newer", "2", "3", True, 0), ("N2", "Oxford", "1", None, None, 1), ("N3", "Oxford", None, None, None, 2),
    ]
    assert rows(dims.dim_zone(stops, at=AT), "zone", "is_boundary_zone", "zone_key", "zone_description") == [
        ("1", False, 0, "Zone 1"), ("2/3", True, 1, "Zone 2/3"),
    ]


def test_facts_keep_unmatched_rows(spark):
    lines = silver.line_status(line_feed(spark), AT)
    line = dims.dim_line(lines, at=AT).where("line_id <> 'dlr'")
    stop = dims.dim_station(silver.stoppoints(feed(spark, "stoppoints", STOP), AT), silver.arrivals(feed(spark, "arrivals", ARRIVAL), AT), at=AT)
    arrivals = silver.arrivals(feed(spark, "arrivals", ARRIVAL, {**ARRIVAL, "id": "2", "lineId": "ghost", "naptanId": "N9", "timestamp": "1999-01-01T23:10:00", "timeToStation": None}), AT)
    fact = facts.fact_arrivals(arrivals, dims.dim_time(spark, AT), line, stop, AT)
    assert len(fact.columns) == 28
    assert rows(fact, "arrival_id", "date_key", "time_key", "line_key", "station_key", "time_to_station_minutes", "period_of_day", "is_peak_hour") == [
        ("1", 20240615, 480, 2, 0, 1.5, "Early Morning", True), ("2", 19990101, 1390, None, None, None, "Late Night", False),
    ]
    statuses = facts.fact_line_status(lines, dims.dim_time(spark, AT), line, dims.dim_disruption(lines, at=AT), AT)
    assert len(statuses.columns) == 20
    assert rows(statuses, "line_id", "line_key", "status_severity", "is_good_service", "is_disrupted") == [
        ("bus", 0, None, False, False), ("dlr", None, None, False, False), ("victoria", 2, 10, True, False), ("victoria", 2, 6, False, True),
    ]
    assert rows(views.line_performance(statuses)) == [
        ("bus", 1, 0, 0, 0.0, None), ("dlr", 1, 0, 0, 0.0, None), ("victoria", 2, 1, 1, 0.5, 6),
    ]
    assert rows(views.station_activity(fact)) == [("N1", "Early Morning", 1, 1, 1, 90.0), ("N9", "Late Night", 1, 1, 1, None)]


def test_last_hours_prunes_folders(spark, tmp_path, capsys):
    times = ["2024-06-14T23:30:00", "2024-06-14T23:10:00", "2024-06-15T00:10:00", "2024-06-15T00:05:00", "2024-06-01T00:00:00"]
    arrivals = silver.arrivals(feed(spark, "arrivals", *({**ARRIVAL, "id": str(i), "timestamp": t} for i, t in enumerate(times))), AT)
    write_partitioned(arrivals, str(tmp_path / "a"))
    table = read_table(spark, str(tmp_path / "a"))
    assert rows(views.last_hours(table, "timestamp"), "id") == [("0",), ("2",), ("3",)]
    assert rows(views.last_hours(table, "timestamp", as_of=datetime(2024, 6, 14, 23, 30)), "id") == [("0",), ("1",)]
    assert views.last_hours(table.where("id = 'x'"), "timestamp").count() == 0
    views.last_hours(table, "timestamp").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(_year" in plan and "GreaterThan(timestamp" in plan


def test_quarantine_and_partition_pruning(spark, tmp_path):
    path = tmp_path / "raw" / "year=2024" / "month=06" / "day=05"
    path.mkdir(parents=True)
    (path / "x.json").write_text(json.dumps(ARRIVAL) + '\n{"id": "broken\n' + json.dumps({**ARRIVAL, "timeToStation": "x"}) + "\n")
    root = str(tmp_path / "raw")
    good, bad = raw.split_lines(raw.parse_lines(raw.read_lines(spark, root), feed_schema("arrivals")))
    assert rows(good, "id", "day") == [("1", 5)] and bad.count() == 2
    assert '{"id": "broken' in [x for (x,) in rows(bad, raw.CORRUPT)]
    scan = raw.read_feed(spark, root, feed_schema("arrivals"))
    assert rows(scan, "id", "month") == [("1", 6), ("1", 6), (None, 6)]
    assert raw.read_feed(spark, root, feed_schema("arrivals"), first=date(2024, 6, 6)).count() == 0
    assert raw.read_feed(spark, root, feed_schema("arrivals"), date(2023, 12, 1), date(2024, 6, 5)).count() == 3


def test_empty_arrays_do_not_change_the_schema(spark):
    out = silver.air_quality(feed(spark, "air_quality", {"currentForecast": []}), AT)
    assert out.count() == 0 and isinstance(out.schema["fromDate"].dataType, T.TimestampType)


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, _day int")
    assert read_table_if_any(spark, path) is None
    write_partitioned(df, path, ["_day"])
    write_partitioned(spark.createDataFrame([(9, 2)], "id int, _day int"), path, ["_day"], only_touched=True)
    assert rows(read_table(spark, path)) == [(1, 1), (3, None), (9, 2)]
    more = spark.createDataFrame([(1, 5), (4, 5)], "id int, _day int")
    for _ in range(2):
        append_new(more, path, ["id"], ["_day"])
    assert rows(read_table(spark, path)) == [(1, 1), (3, None), (4, 5), (9, 2)]
    write_partitioned(df, path, ["_day"])
    assert rows(read_table(spark, path)) == [(1, 1), (2, 2), (3, None)]
    write_dimension(df, str(tmp_path / "d"))
    write_dimension(df.limit(1), str(tmp_path / "d"))
    assert read_table(spark, str(tmp_path / "d")).count() == 1


def test_observed_counts_without_another_scan(spark, tmp_path):
    df, seen = observed(spark.range(10), "ten", {"even": F.count_if(F.col("id") % 2 == 0)})
    write_dimension(df, str(tmp_path / "o"))
    assert seen.get == {"rows": 10, "even": 5}


def test_quality(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "never"), (None, None)], "id string, t string")
    want = T.StructType.fromDDL("id STRING, t TIMESTAMP, gone INT")
    report = quality_report(df, Expectations(("id",), ("id",), ("t",), want))
    assert rows(report) == sorted([
        ("not_null", "id", 1, 3, False), ("timestamp", "t", 1, 3, False), ("unique", "id", 1, 3, False),
        ("schema", "id", 0, 3, True), ("schema", "t", 1, 3, False), ("schema", "gone", 1, 3, False),
    ], key=repr)
    health = health_report({"x": (df, None, Expectations(("id",), ("id", "t"))), "y": (df.limit(0), None, Expectations(("id",), ("id",)))})
    assert rows(health) == [("x", 3, None, 0.5), ("y", 0, None, 1.0)]
    with pytest.raises(ValueError):
        quality_report(df, Expectations())


def lay(spark, root, records):
    for name, batch in records.items():
        lines = [(json.dumps({"_ingested_at": POLL, **x}), x.get("_ingested_at", POLL)) for x in batch]
        day = raw.with_day_folders(spark.createDataFrame(lines, "value string, at string"), "at").drop("at")
        write_partitioned(day, f"{root}/{name}", raw.DAY_FOLDERS, mode="append", fmt="text")


def test_refresh_and_backfill(spark, tmp_path):
    root, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    records = {
        "arrivals": [ARRIVAL], "line_status": [{**LINE, "lineStatuses": [status(10)]}], "bikepoints": [{"id": "B1"}],
        "stoppoints": [STOP], "air_quality": [{"currentForecast": [{"forecastID": "F", "forecastType": "C"}]}],
        "accidents": [{"id": 1, "date": "2019-01-01T00:00:00Z"}],
    }
    lay(spark, root, records)
    counts = {}
    for turn in range(2):
        paths = refresh.refresh(spark, root, f"{out}/silver", f"{out}/gold", at=AT)
        counts[turn] = {n: read_table(spark, p).count() for n, p in paths.items()}
    assert counts[0] == counts[1] == {**dict.fromkeys(counts[0], 1), "dim_date": 366, "dim_time": 1440, "dim_zone": 0}

    key = rows(read_table(spark, paths["dim_line"]), "line_id", "line_key")
    lay(spark, root, {
        "line_status": [{**LINE, "id": "bakerloo", "lineStatuses": []}],
        "arrivals": [{**ARRIVAL, "id": "2", "timestamp": "2024-06-16T09:00:00", "_ingested_at": "2024-06-20T00:00:00Z"}],
        "stoppoints": [{**STOP, "commonName": "Renamed", "_ingested_at": "2024-06-16T00:00:00Z"}],
    })
    refresh.backfill(spark, "arrivals", f"{root}/arrivals", paths["arrivals"], date(2024, 6, 16), date(2024, 6, 16), at=AT)
    assert rows(read_table(spark, paths["arrivals"]), "id") == [("1",), ("2",)]
    refresh.backfill(spark, "stoppoints", f"{root}/stoppoints", paths["stoppoints"], date(2024, 6, 16), date(2024, 6, 16), at=AT)
    assert rows(read_table(spark, paths["stoppoints"]), "id", "commonName", "_day") == [("N1", "Renamed", 16)]
    refresh.refresh(spark, root, f"{out}/silver", f"{out}/gold", at=AT)
    assert rows(read_table(spark, paths["dim_line"]), "line_id", "line_key") == [("bakerloo", 1), *key]


def test_jobs(spark, tmp_path, capsys):
    from siltstone.__main__ import parser, run

    bronze, out, gold = (str(tmp_path / x) for x in ("bronze", "silver", "gold"))
    lay(spark, bronze, {
        "arrivals": [ARRIVAL, {**ARRIVAL, "id": "2", "timestamp": "2024-06-16T09:00:00"}], "line_status": [{**LINE, "lineStatuses": [status(10)]}],
        "bikepoints": [{"id": "B1"}], "stoppoints": [STOP], "air_quality": [{"currentForecast": [{"forecastID": "F", "forecastType": "C"}]}],
        "accidents": [{"id": 1, "date": "2019-01-01T00:00:00Z"}],
    })
    roots = ["--bronze", bronze, "--silver", out, "--at", AT]

    def do(*argv):
        run(spark, parser().parse_args([str(a) for a in argv]))

    do("silver", "arrivals", *roots)
    assert "arrivals: 2 rows" in capsys.readouterr().out
    do("refresh", *roots, "--gold", gold)
    fact = f"{gold}/facts/fact_arrivals"
    do("gold", "fact_arrivals", "--silver", out, "--gold", gold, "--at", "2024-08-01 00:00:00", "--first", "2024-06-16")
    stamped = read_table(spark, fact).select("arrival_id", F.month("_gold_processed_at"))
    assert rows(stamped) == [("1", 7), ("2", 8)]
    do("backfill", "arrivals", *roots, "--first", "2024-06-15", "--last", "2024-06-16")
    state = tmp_path / "state"
    lay(spark, bronze, {"arrivals": [{**ARRIVAL, "id": "3"}]})
    for _ in range(2):
        do("stream", "arrivals", *roots, "--state", state)
    assert rows(read_table(spark, f"{out}/arrivals"), "id") == [("1",), ("2",), ("3",)]
    do("quarantine", "arrivals", "--bronze", bronze, "--to", tmp_path / "bad")
    do("health", "--silver", out)
    assert "|arrivals   |3   |" in capsys.readouterr().out
