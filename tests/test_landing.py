"""Landed files: compressed, of bounded size, read back as they were written."""

from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from siltstone.sources import feeds as raw
from siltstone.streaming import jobs


def predictions(spark, rows):
    """``rows`` records of one day with a list that repeats its names, as landed feeds do."""
    names = F.array(*(F.struct(F.lit(f"Property{k}").alias("key"), F.col("id").cast("string").alias("value")) for k in range(8)))
    return spark.range(rows).select("id", names.alias("properties"), F.lit("2024-06-01T08:00:00Z").alias("_ingested_at"))


def landed_files(path):
    return sorted(p for p in path.rglob("part-*"))


def test_landed_files_are_compressed(spark, tmp_path):
    df = predictions(spark, 2000)
    raw.land(df, str(tmp_path / "bronze"), "_ingested_at")
    files = landed_files(tmp_path / "bronze")
    plain = sum(len(gzip.decompress(p.read_bytes())) for p in files)
    assert plain > 8 * sum(p.stat().st_size for p in files)
    back = raw.read_feed(spark, str(tmp_path / "bronze"), df.schema)
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))


def test_a_day_lands_in_files_of_bounded_size(spark, tmp_path):
    raw.land(predictions(spark, 250_000).coalesce(1), str(tmp_path), "_ingested_at")
    most = int(raw.LANDED_OPTIONS["maxRecordsPerFile"])
    sizes = [gzip.decompress(p.read_bytes()).count(b"\n") for p in landed_files(tmp_path)]
    assert sum(sizes) == 250_000 and max(sizes) <= most


def test_a_stream_lands_compressed_files(spark, tmp_path):
    df = predictions(spark, 500)
    df.write.json(str(tmp_path / "in"))
    stream = jobs.read_feed_stream(spark, str(tmp_path / "in"), df.schema)
    jobs.land_stream(stream, str(tmp_path / "bronze"), str(tmp_path / "state"), "_ingested_at")
    files = landed_files(tmp_path / "bronze")
    assert files and all(p.read_bytes()[:2] == b"\x1f\x8b" for p in files)
    assert raw.read_feed(spark, str(tmp_path / "bronze"), df.schema).select(*df.columns).exceptAll(df).isEmpty()
