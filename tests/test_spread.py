"""Narrow rows dealt over bounded tasks, records found without making all, backfills written once."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import functions as F

from conftest import rows
from siltstone.plans import refresh
from workload import feeds


def test_rows_are_dealt_evenly_over_bounded_tasks(spark, tmp_path):
    spark.range(5 * feeds.SPREAD_ROWS // 2).select("id", (F.col("id") % 7).alias("x")).coalesce(1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    dealt = feeds.spread(table)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 3 and max(sizes) < 1.1 * feeds.SPREAD_ROWS
    assert dealt.exceptAll(table).isEmpty() and dealt.count() == table.count()


def test_a_small_or_empty_table_is_left_where_it_is(spark):
    for count in (0, 1, 10):
        assert rows(feeds.spread(spark.range(count))) == [(i,) for i in range(count)]


def test_readings_of_a_dock_come_in_tasks_of_bounded_size(spark, tmp_path):
    n = F.col("id")
    spark.range(feeds.SPREAD_ROWS + 1000).select(
        n.alias("l_orderkey"), n.alias("l_partkey"), (n % 9).alias("l_suppkey"), (n % 7).cast("int").alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"), F.lit(0.1).alias("l_discount"), F.lit(0.2).alias("l_tax"), F.lit("A").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.lit("1995-02-01").cast("timestamp").alias("l_shipdate"),
    ).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    docks = feeds.bikepoints(spark, str(tmp_path))
    assert docks.groupBy(F.spark_partition_id()).count().count() == 2
    assert docks.count() == feeds.SPREAD_ROWS + 1000


def test_a_backfill_writes_rows_once_before_the_merge(spark, tmp_path, monkeypatch):
    folder = tmp_path / "bronze" / "year=2024" / "month=06" / "day=15"
    folder.mkdir(parents=True)
    record = {"id": "1", "naptanId": "S1", "lineId": "L", "timestamp": "2024-06-15T08:00:00Z", "_ingested_at": "2024-06-15T08:00:10Z"}
    (folder / "0.json").write_text("".join(json.dumps({**record, "id": str(i % 3), "towards": str(i)}) + "\n" for i in range(6)))
    written, materialise = [], refresh.materialise
    monkeypatch.setattr(refresh, "materialise", lambda df, label: written.append(label) or materialise(df, label))
    path = str(tmp_path / "silver")
    for _ in range(2):
        refresh.backfill(spark, "arrivals", str(tmp_path / "bronze"), path, date(2024, 6, 15), date(2024, 6, 15))
    assert written == []
    assert rows(spark.read.parquet(path), "id", "towards") == [("0", "0"), ("1", "1"), ("2", "2")]
