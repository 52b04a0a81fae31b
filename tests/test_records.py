import hashlib
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from siltstone.operators import records as r

AT = "2024-06-15T08:00:00+00:00"


def test_metadata_is_added_and_payload_kept(spark):
    df = spark.createDataFrame([("1", "x")], "id string, v string")
    out = r.with_metadata(df, "poller", "feed.x", AT)
    assert rows(out) == [("1", "x", AT, "poller", "feed.x")]
    assert df.columns == ["id", "v"]


def digest(record):
    return hashlib.sha1(json.dumps(record, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def test_arrival_key(spark):
    df = spark.createDataFrame([("1", "V1"), ("2", ""), ("3", None)], "id string, vehicleId string")
    keys = [k for _, k in rows(df.select("id", r.message_key(df, "arrivals")))]
    assert keys == ["V1", digest({"id": "2", "vehicleId": ""}), digest({"id": "3"})]
    enriched = r.with_metadata(df, "poller", "feed.x", AT)
    assert [k for _, k in rows(enriched.select("id", r.message_key(enriched, "arrivals")))] == keys


@pytest.mark.parametrize("feed, columns, values, key", [
    ("accidents", "id bigint, v string", (7, "x"), "7"),
    ("bikepoints", "id string, stationId string", ("B1", "S1"), "B1"),
    ("bikepoints", "id string, stationId string", ("", "S1"), "S1"),
    ("bikepoints", "id string", (None,), "unknown"),
    ("line_status", "lineId string", ("L1",), "L1"),
    ("stoppoints", "naptanId string, id string", ("N1", "I1"), "N1"),
    ("stoppoints", "naptanId string, id string", (None, "I1"), "I1"),
    ("stoppoints", "naptanId string, id string", (None, ""), "unknown"),
    ("air_quality", "v string, _ingested_at string", ("x", AT), "2024-06-15"),
])
def test_keys_of_other_feeds(spark, feed, columns, values, key):
    df = spark.createDataFrame([values], columns)
    assert df.select(r.message_key(df, feed)).first()[0] == key


def test_accident_without_id_is_fingerprinted(spark):
    df = spark.createDataFrame([(None, "x")], "id bigint, v string")
    assert df.select(r.message_key(df, "accidents")).first()[0] == digest({"v": "x"})


def test_records(spark):
    df = spark.createDataFrame([("a", 1, [("k", "v")])], "id string, n int, p array<struct<key: string, value: string>>")
    row = r.to_records(df, F.col("id")).first()
    assert row["key"] == "a" and json.loads(row["value"]) == {"id": "a", "n": 1, "p": [{"key": "k", "value": "v"}]}


ITEM = "id string, n int"


@pytest.mark.parametrize("body, ids", [
    ('[{"id":"a"},{"id":"b"}]', ["a", "b"]), ('{"id":"a"}', ["a"]), ("[]", []), ("3", []), ('"text"', []), ("not json", []),
    (None, []),
])
def test_unwrap(spark, body, ids):
    df = spark.createDataFrame([(1, body)], "call int, value string")
    out = r.unwrap_payload(df, T.StructType.fromDDL(ITEM))
    assert out.columns == ["call", "id", "n"] and [x for _, x in rows(out, "call", "id")] == ids


@pytest.mark.parametrize("body, ids", [
    ('{"stopPoints":[{"id":"a"},{"id":"b"}],"total":2}', ["a", "b"]), ('{"stopPoints":[]}', []), ('{"total":0}', []),
    ('[{"id":"a"}]', ["a"]), ("3", []),
])
def test_unwrap_envelope(spark, body, ids):
    df = spark.createDataFrame([(body,)], "value string")
    out = r.unwrap_payload(df, T.StructType.fromDDL(ITEM), wrapper="stopPoints")
    assert [x for (x,) in rows(out, "id")] == ids


def test_union_of_batches(spark):
    a = spark.createDataFrame([("1", 1)], "id string, a int")
    b = spark.createDataFrame([(2, "2")], "b int, id string")
    assert rows(r.union_batches([a, b, a]), "id", "a", "b") == [("1", 1, None), ("1", 1, None), ("2", None, 2)]
