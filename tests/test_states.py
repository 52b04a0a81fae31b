"""States kept by folder: what is read again, and what merging gives."""

from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators import states
from siltstone.operators.quality import (
    Expectations, health_of_profiles, health_report, merged_profile, profile, quality_of_profiles, quality_report,
)
from siltstone.plans import views
from siltstone.sources import commits
from siltstone.sources.files import remove
from siltstone.sources.sinks import write_partitioned

DAY = ["_day"]
ROW = "id int, a string, at string, seen timestamp_ntz, _day int"


def table(spark, days, marker="x"):
    made = spark.range(40).select(
        F.col("id").cast("int").alias("id"), F.when(F.col("id") % 7 > 0, F.lit(marker)).alias("a"),
        F.when(F.col("id") % 5 == 0, "never").otherwise("2024-01-01").alias("at"),
        F.timestamp_seconds(F.col("id") * 60).alias("seen"), (F.col("id") % 6).cast("int").alias("_day"),
    )
    made = made.unionByName(made.where("id < 3"))
    return made.withColumn("_day", F.nullif("_day", F.lit(5))).where(F.coalesce("_day", F.lit(5)).isin(days))


EXPECT = Expectations(("a", "id"), ("id", "_day"), ("at",))


def kept(spark, path, profiles):
    return states.keep_states(spark, path, profiles, lambda df, days: profile(df, EXPECT, days, "seen"), DAY)


def test_only_changed_folders_are_read(spark, tmp_path):
    path, profiles = str(tmp_path / "t"), str(tmp_path / "p")
    write_partitioned(table(spark, [0, 1, 5]), path, DAY)
    assert kept(spark, path, profiles) == {"_day=0", "_day=1", "_day=__HIVE_DEFAULT_PARTITION__"}
    assert kept(spark, path, profiles) == set()
    write_partitioned(table(spark, [2, 3, 4]), path, DAY, mode="append")
    assert kept(spark, path, profiles) == {"_day=2", "_day=3", "_day=4"}
    write_partitioned(table(spark, [1], "y").limit(2), path, DAY, only_touched=True)
    assert kept(spark, path, profiles) == {"_day=1"}
    remove(spark, [f"{path}/_day=0"])
    assert kept(spark, path, profiles) == set()
    spark.catalog.refreshByPath(path)
    now, read = spark.read.parquet(path), states.read_states(spark, profiles)
    assert read.count() == 5
    assert rows(quality_of_profiles(read, EXPECT)) == rows(quality_report(now, EXPECT))
    assert rows(health_of_profiles({"t": (read, EXPECT)})) == rows(health_report({"t": (now, "seen", EXPECT)}))


def test_a_stop_leaves_states_that_the_next_run_makes_good(spark, tmp_path, monkeypatch):
    path, profiles = str(tmp_path / "t"), str(tmp_path / "p")
    write_partitioned(table(spark, [0, 1]), path, DAY)
    kept(spark, path, profiles)
    write_partitioned(table(spark, [2]), path, DAY, mode="append")

    class Stopped(BaseException):
        pass

    def stop(*args):
        raise Stopped

    with monkeypatch.context() as patched:
        patched.setattr(commits, "write_text", stop)
        try:
            kept(spark, path, profiles)
            raise AssertionError
        except Stopped:
            pass
    assert states.read_states(spark, profiles).count() == 2
    assert kept(spark, path, profiles) == {"_day=2"}
    assert states.read_states(spark, profiles).count() == 3


def test_distinct_keys_within_their_bound(spark):
    df = spark.range(60000).select((F.col("id") % 20000).alias("id"), (F.col("id") % 9).alias("_day"))
    expect = Expectations(unique=("id",))
    found = merged_profile(profile(df, expect, DAY), expect).first()
    assert found["rows"] == 60000 and abs(found["distinct_keys"] - 20000) < 4 * 0.0163 * 20000


def test_empty_table_has_an_empty_profile(spark):
    empty = spark.createDataFrame([], "id int, _day int")
    expect = Expectations(("id",), ("id",))
    assert rows(quality_of_profiles(profile(empty, expect, DAY), expect)) == rows(quality_report(empty, expect))


def test_views_merge_from_states(spark):
    fact = spark.createDataFrame(
        [(d, s, "Morning", v, l, w) for d in (1, 2, None) for s, v, l, w in (("a", "v1", "l", 10), ("a", "v1", "m", None), ("b", None, "l", 4))],
        "_day int, naptan_id string, period_of_day string, vehicle_id string, line_id string, time_to_station_seconds int",
    )
    assert rows(views.merged_stations(views.station_states(fact, DAY))) == rows(views.station_activity(fact)) == [
        ("a", "Morning", 6, 1, 2, 10.0), ("b", "Morning", 3, 0, 1, 4.0),
    ]
    status = spark.createDataFrame(
        [(d, l, g, not g, s) for d in (1, 2) for l, g, s in (("x", True, 10), ("x", False, 3), (None, True, None))],
        "_day int, line_id string, is_good_service boolean, is_disrupted boolean, status_severity int",
    )
    assert rows(views.merged_lines(views.line_states(status, DAY))) == rows(views.line_performance(status)) == [
        ("x", 4, 2, 2, 0.5, 3), (None, 2, 2, 0, 1.0, None),
    ]
