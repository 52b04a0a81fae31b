"""What a refresh keeps on disk while it runs: no copy of the landed records, no shuffle of a job that has ended."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from conftest import rows
from siltstone.plans import refresh, silver
from siltstone.schemas import feed_schema
from siltstone.session import materialise
from siltstone.sources import feeds as raw
from siltstone.sources.commits import quarantined
from siltstone.sources.tables import read_table
from workload import feeds

AT = "2024-06-16 00:00:00"


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(disk.apply(i).getName().startswith("shuffle_") for i in range(disk.size()))


def deliver(tmp_path, feed, *lines, day=15):
    folder = tmp_path / "bronze" / feed / "year=2024" / "month=06" / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("".join(f"{x if isinstance(x, str) else json.dumps(x)}\n" for x in lines))


def arrival(i, **more):
    return {"id": i, "naptanId": "S1", "lineId": "L", "timestamp": "2024-06-15T08:00:00Z", "_ingested_at": "2024-06-15T08:00:10Z", **more}


def test_a_rebuild_writes_no_copy_of_the_records(spark, tmp_path, monkeypatch):
    written, write = [], refresh.materialise
    monkeypatch.setattr(refresh, "materialise", lambda df, label, **how: written.append(label) or write(df, label, **how))
    bronze, path = str(tmp_path / "bronze" / "arrivals"), str(tmp_path / "silver")
    deliver(tmp_path, "arrivals", arrival("1", towards="b"), arrival("1", towards="a"), arrival("2"))
    refresh.refresh_silver(spark, "arrivals", bronze, path, AT)
    assert written == ["files", "cleaned"] and quarantined(spark, path) is None

    # A field that cleaning does not look at is enough for a line to be set aside.
    odd = json.dumps(arrival("3", operationType="first", towards="c"))
    topic = json.dumps(arrival("4", timeToStation="soon"))
    deliver(tmp_path, "arrivals", odd, topic, '{"id": "cut', arrival("no line", lineId=None), day=16)
    written.clear()
    seen = refresh.refresh_silver(spark, "arrivals", bronze, path, AT)
    assert written == ["files", "cleaned", "bad"] and seen.get["rows"] == 4
    whole = silver.arrivals(raw.read_feed(spark, bronze, feed_schema("arrivals")), AT)
    assert rows(read_table(spark, path), *whole.columns) == rows(whole)
    aside = rows(quarantined(spark, path), "reason", "line")
    assert [r for r, _ in aside] == ["incomplete", "unparsed", "unparsed", "unparsed"]
    assert {odd, topic, '{"id": "cut'} <= {line for _, line in aside} and '"id":"no line"' in aside[0][1]


def test_shuffles_go_with_their_job(spark, tmp_path):
    kept = shuffle_files(spark)
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "plain"))
    # This one stays: it shows that the count sees what it should.
    assert shuffle_files(spark) > kept
    kept = shuffle_files(spark)
    materialise(spark.range(100).repartition(3), "x")
    assert shuffle_files(spark) <= kept
    for i in range(3):
        deliver(tmp_path, "arrivals", arrival(str(i)), arrival(str(i)))
        deliver(tmp_path, "accidents", {"id": i, "date": "2024-06-15T08:00:00Z", "_ingested_at": "2024-06-15T08:00:10Z"})
    for feed in ("arrivals", "accidents"):
        for _ in range(2):
            refresh.refresh_silver(spark, feed, str(tmp_path / "bronze" / feed), str(tmp_path / feed), AT)
        assert read_table(spark, str(tmp_path / feed)).count() == 3
    raw.land(spark.range(9).select("id", F.lit("2024-06-15T08:00:00Z").alias("t")), str(tmp_path / "landed"), "t")
    assert shuffle_files(spark) <= kept + 4  # the two counts above
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_events_are_dealt_by_day_and_land_where_they_are(spark, tmp_path, capsys):
    n, count = F.col("id"), 3 * feeds.SPREAD_ROWS
    spark.range(count).select(
        n.alias("event_id"), F.timestamp_seconds(1_704_067_200 + (n % 30) * 86_400).cast("timestamp_ntz").alias("ts"), (n % 999).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit('{"k": 3}').alias("props"),
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    statuses = feeds.line_status(spark, str(tmp_path))
    tasks = statuses.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.countDistinct(F.substring("_ingested_at", 1, 10)).alias("days")).collect()
    assert sum(t["n"] for t in tasks) == count and max(t["n"] for t in tasks) < 1.5 * feeds.SPREAD_ROWS
    assert sum(t["days"] for t in tasks) <= 30 + len(tasks)
    raw.land(statuses, str(tmp_path / "bronze"), "_ingested_at", filed=True)
    landed = list((tmp_path / "bronze").rglob("*.json.gz"))
    assert 30 <= len(landed) <= 30 + len(tasks)
    back = raw.read_feed(spark, str(tmp_path / "bronze"), feed_schema("line_status"))
    assert back.count() == count and back.select("year", "month", "day").distinct().count() == 30
