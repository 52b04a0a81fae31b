"""A second run must give what a rebuild gives, and a failed one must leave what was there."""

import json
import os
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.functions.cleaning import with_partition_columns
from siltstone.operators import merge, starjoin, surrogate
from siltstone.plans import dims, refresh, silver, views
from siltstone.schemas import feed_schema
from siltstone.session import scratch_scope, shared_dir
from siltstone.sources import files
from siltstone.sources.feeds import parse_lines
from siltstone.sources.sinks import write_dimension, write_partitioned
from siltstone.sources.tables import read_table


def land(root, day, *records):
    folder = root / f"year={day.year}" / f"month={day.month:02d}" / f"day={day.day:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / f"{len(os.listdir(folder))}.json", "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in records)


def accident(i, borough, day, ingested):
    return {"id": i, "borough": borough, "date": f"2024-06-{day:02d}T10:00:00Z", "severity": "Slight", "_ingested_at": f"2024-06-{ingested:02d}T12:00:00Z"}


def accidents(spark, bronze, path):
    refresh.refresh_silver(spark, "accidents", str(bronze), str(path), "2024-07-01 00:00:00")
    return rows(read_table(spark, str(path)), "id", "borough", "_day")


def test_correction_of_a_known_accident(spark, tmp_path):
    bronze, path = tmp_path / "bronze", tmp_path / "silver"
    land(bronze, date(2024, 6, 1), accident(1, "old", 1, 1), accident(2, "b", 1, 1))
    accidents(spark, bronze, path)
    land(bronze, date(2024, 6, 3), accident(1, "corrected", 2, 3))
    assert accidents(spark, bronze, path) == accidents(spark, bronze, tmp_path / "rebuilt") == [(1, "corrected", 2), (2, "b", 1)]


def test_staging_that_fills_during_the_load(spark, tmp_path, monkeypatch):
    staging, table = str(tmp_path / "staging"), str(tmp_path / "table")
    day = lambda df: with_partition_columns(df.withColumn("ts", F.timestamp_seconds("id")), "ts")
    first, late = day(spark.range(3)), day(spark.range(10, 12))
    first.write.parquet(staging)
    upsert = merge.upsert_table

    def slow(*args, **options):
        upsert(*args, **options)
        late.write.mode("append").parquet(staging)

    monkeypatch.setattr(merge, "upsert_table", slow)
    merge.incremental_load(spark, staging, table, first.schema, ["id"], ["ts"])
    monkeypatch.setattr(merge, "upsert_table", upsert)
    assert rows(read_table(spark, staging), "id") == [(10,), (11,)]
    merge.incremental_load(spark, staging, table, first.schema, ["id"], ["ts"])
    assert rows(read_table(spark, table), "id") == [(i,) for i in (0, 1, 10, 11, 2)] or read_table(spark, table).count() == 5
    assert read_table(spark, staging).count() == 0


def filed(spark, values, schema):
    return spark.createDataFrame(values, f"{schema}, _year int, _month int, _day int")


def test_upsert_keeps_new_and_wider_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(filed(spark, [(1, 1, 1, 2024, 1, 1), (2, 1, 2, 2024, 1, 2)], "id int, v int, n int"), path)
    merge.upsert_table(path, filed(spark, [(2, 2, 7, "x", 2024, 1, 2)], "id int, v int, n int, extra string"), ["id"], ["v"])
    assert rows(read_table(spark, path), "id", "v", "n", "extra") == [(1, 1, 1, None), (2, 2, 7, "x")]
    merge.upsert_table(path, filed(spark, [(1, 3, 5.5, 2024, 1, 1)], "id int, v int, n double"), ["id"], ["v"])
    assert rows(read_table(spark, path), "id", "v", "n", "extra") == [(1, 3, 5.5, None), (2, 2, 7.0, "x")]


def backfill(spark, bronze, path):
    refresh.backfill(spark, "accidents", str(bronze), str(path), date(2024, 6, 1), date(2024, 6, 3), at="2024-07-01 00:00:00")
    return rows(read_table(spark, str(path)), "id", "borough", "_day")


def test_backfill_gives_up_what_moved_or_went(spark, tmp_path):
    bronze, path = tmp_path / "bronze", tmp_path / "silver"
    land(bronze, date(2024, 6, 1), accident(1, "stays", 1, 1), accident(2, "moves", 2, 1))
    land(bronze, date(2024, 6, 2), accident(3, "withdrawn", 3, 2))
    land(bronze, date(2024, 6, 9), accident(9, "later", 9, 9))
    accidents(spark, bronze, path)
    (bronze / "year=2024/month=06/day=02/0.json").unlink()
    land(bronze, date(2024, 6, 10), accident(2, "moved", 10, 10))
    want = [(1, "stays", 1), (2, "moved", 10), (9, "later", 9)]
    assert backfill(spark, bronze, path) == want
    assert backfill(spark, bronze, path) == want


def test_backfill_without_raw_data_is_an_error(spark, tmp_path):
    bronze, path = tmp_path / "bronze", tmp_path / "silver"
    land(bronze, date(2024, 6, 1), accident(1, "a", 1, 1))
    before = accidents(spark, bronze, path)
    (bronze / "year=2024/month=06/day=01/0.json").unlink()
    (bronze / "year=2024/month=06/day=01").rmdir()
    land(bronze, date(2024, 6, 20), accident(5, "e", 20, 20))
    with pytest.raises(ValueError, match="has gone"):
        backfill(spark, bronze, path)
    assert rows(read_table(spark, str(path)), "id", "borough", "_day") == before


def test_keys_are_never_given_again(spark):
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    first = surrogate.assign_keys(frame("abc"), ["name"], "key")
    second = surrogate.assign_keys(frame("ab"), ["name"], "key", first)
    third = surrogate.assign_keys(frame("abz"), ["name"], "key", second)
    keys = dict(rows(third, "name", "key"))
    assert len(set(keys.values())) == 4 and keys["c"] == dict(rows(first, "name", "key"))["c"]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "dim")
    write_dimension(spark.range(3), path)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_dimension(broken, path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    assert os.listdir(tmp_path) == ["dim"]
    write_dimension(spark.read.parquet(path).where("id > 0"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_intermediates_go_after_each_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    held = lambda: len(os.listdir(shared_dir(spark)))
    before = held()
    for n in range(10):
        merge.upsert_table(path, filed(spark, [(n % 3, n, 2024, 1, 1 + n % 2)], "id int, v int"), ["id"], ["v"])
    assert held() == before and read_table(spark, path).count() == 3


def test_scope_ends_on_failure(spark):
    from siltstone.session import materialise

    before = os.listdir(shared_dir(spark))
    with pytest.raises(KeyError), scratch_scope(spark):
        materialise(spark.range(2), "x")
        raise KeyError
    assert os.listdir(shared_dir(spark)) == before


def test_key_below_a_thousandth_is_cut_when_partitions_are_many(spark):
    fact = spark.range(4000).select(F.when(F.col("id") < 3, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert starjoin.heavy_keys(fact, "k").count() == 0
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1500")
    try:
        assert rows(starjoin.heavy_keys(fact, "k"), "_heavy") == [(-1,)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_newest_folder_by_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    times = spark.range(50).select(F.col("id"), F.timestamp_seconds(F.col("id") * 7200).alias("time"))
    write_partitioned(with_partition_columns(times, "time"), path)
    assert files.folder_values(spark, path, ("_year", "_month", "_day"))[-1] == (1970, 1, 5)
    table = read_table(spark, path)
    assert rows(views.last_hours(table, "time", 3, path=path), "id") == rows(views.last_hours(table, "time", 3), "id") == [(48,), (49,)]


def test_activity_does_not_multiply_rows(spark):
    fact = spark.createDataFrame(
        [("s", "am", "v1", "l1", 60), ("s", "am", "v1", "l2", None), ("s", "am", None, "l1", 30), (None, None, None, None, None)],
        "naptan_id string, period_of_day string, vehicle_id string, line_id string, time_to_station_seconds int",
    )
    got = rows(views.station_activity(fact))
    assert got == sorted([("s", "am", 3, 1, 2, 45.0), (None, None, 1, 0, 0, None)], key=repr)


def test_stops_known_by_id_only(spark):
    schema = feed_schema("stoppoints")
    lines = [json.dumps({"id": i, "commonName": n, "_ingested_at": "2024-06-01T00:00:00Z"}) for i, n in (("x", "X"), ("y", "Y"))]
    parsed = parse_lines(spark.createDataFrame([(x,) for x in [*lines, "", "  "]], "value string"), schema)
    assert parsed.count() == 2
    stops = silver.stoppoints(parsed.drop("_corrupt_record"))
    arrivals = silver.arrivals(spark.createDataFrame([], feed_schema("arrivals")))
    assert rows(dims.dim_station(stops, arrivals), "naptan_id", "common_name") == [("x", "X"), ("y", "Y")]


def test_messages_that_do_not_parse_are_kept(spark):
    from siltstone.sources.feeds import split_lines
    from siltstone.streaming.jobs import parse_messages

    values = [b'{"id": "a", "commonName": "A"}', b"{broken", b" ", b'{"id": "b"}']
    frame = spark.createDataFrame([(b"k", v) for v in values], "key binary, value binary")
    good, bad = split_lines(parse_messages(frame, feed_schema("stoppoints")))
    assert rows(good, "id") == [("a",), ("b",)] and rows(bad, "_corrupt_record") == [("{broken",)]
