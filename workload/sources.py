"""Scans, sinks, landing, quarantine, metrics and message shaping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F, types as T

from siltstone.functions.cleaning import require, with_partition_columns
from siltstone.operators import records as r
from siltstone.plans import silver
from siltstone.schemas import feed_schema
from siltstone.session import scratch_path
from siltstone.sources import feeds as raw
from siltstone.sources.sinks import append_new, observed, write_dimension, write_partitioned
from siltstone.sources.tables import read_table
from workload import feeds, sql
from workload.registry import AT, query

def event_schema():
    return T.StructType.fromDDL(
        "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRUCT<k: INT>"
    )


def event_records(spark, sf_dir):
    """Events as JSON-ready rows: ISO text for the time, a nested object for the properties."""
    return feeds.table(spark, sf_dir, "events").withColumns(
        {"ts": feeds.iso(F.col("ts")), "props": F.from_json("props", "k INT")}
    )


def landed_events(spark, sf_dir):
    path = scratch_path(spark, "events-raw")
    raw.land(event_records(spark, sf_dir), path, "ts")
    return path


@query(f"select event_id, ts, user_id, event_type, value, {sql.K} as k from events")
def scan_json_typed(spark, sf_dir):
    df = raw.read_feed(spark, landed_events(spark, sf_dir), event_schema())
    return df.select("event_id", F.try_to_timestamp("ts").alias("ts"), "user_id", "event_type", "value", "props.k")


@query("""
select event_id, event_type, value, cast(day(ts) as integer) as day from events
where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15'""")
def scan_partition_pruned(spark, sf_dir):
    df = raw.read_feed(spark, landed_events(spark, sf_dir), event_schema(), date(2024, 1, 8), date(2024, 1, 14))
    return df.select("event_id", "event_type", "value", "day")


@query("select o_orderkey, o_custkey, o_totalprice from orders")
def scan_parquet_project(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


@query("""
select event_id, user_id, case when day(ts) = 15 then value * 2 else value end as value,
  cast(year(ts) as integer) as _year, cast(month(ts) as integer) as _month, cast(day(ts) as integer) as _day
from events""")
def sink_overwrite_partitioned(spark, sf_dir):
    events = with_partition_columns(feeds.table(spark, sf_dir, "events"), "ts").select(
        "event_id", "user_id", "value", "_year", "_month", "_day"
    )
    path = scratch_path(spark, "overwrite")
    write_partitioned(events, path)
    redone = events.where("_day = 15").withColumn("value", F.col("value") * 2)
    write_partitioned(redone, path, only_touched=True)
    return read_table(spark, path)


@query("select c_custkey, c_name, c_mktsegment from customer")
def sink_overwrite_dim(spark, sf_dir):
    members = feeds.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = scratch_path(spark, "dimension")
    write_dimension(members.withColumn("c_name", F.upper("c_name")), path)
    write_dimension(members, path)
    return read_table(spark, path)


@query("""
select event_id, user_id, event_type, cast(year(ts) as integer) as _year, cast(month(ts) as integer) as _month,
  cast(day(ts) as integer) as _day from events""")
def sink_append_idempotent(spark, sf_dir):
    events = with_partition_columns(feeds.table(spark, sf_dir, "events"), "ts").select(
        "event_id", "user_id", "event_type", "_year", "_month", "_day"
    )
    path = scratch_path(spark, "append")
    for batch in (events.where("event_type <> 'error'"), events, events):
        append_new(batch, path, ["event_id"])
    return read_table(spark, path)


@query("""
select cast(day(ts) as integer) as day, event_type = 'error' as quarantined, count(*) as lines,
  cast(sum(case when event_type <> 'error' then user_id end) as bigint) as users
from events group by day(ts), event_type = 'error'""")
def quarantine_bad_records(spark, sf_dir):
    """Lines of error events lose their closing brace on the way."""
    rows = raw.with_day_folders(event_records(spark, sf_dir), "ts")
    line = F.to_json(F.struct(*(c for c in rows.columns if c not in raw.DAY_FOLDERS)))
    cut = F.when(F.col("event_type") == "error", F.expr("left(_line, length(_line) - 1)")).otherwise(F.col("_line"))
    path = scratch_path(spark, "lines")
    lines = rows.withColumn("_line", line).select(cut.alias("value"), *raw.DAY_FOLDERS)
    write_partitioned(lines, path, raw.DAY_FOLDERS, fmt="text")

    good, bad = raw.split_lines(raw.parse_lines(raw.read_lines(spark, path), event_schema()))
    count = F.count(F.lit(1)).alias("lines")
    return r.union_batches([
        good.groupBy("day").agg(count, F.sum("user_id").alias("users")).withColumn("quarantined", F.lit(False)),
        bad.groupBy("day").agg(count).withColumn("quarantined", F.lit(True)),
    ])


#: Fields of landed predictions that tell what was landed, and the folders they lie in.
LANDED = (
    "id", "vehicleId", "naptanId", "stationName", "lineId", "lineName", "platformName", "direction", "destinationNaptanId",
    "destinationName", "timestamp", "timeToStation", "currentLocation", "towards", "timeToLive", "modeName", "_ingested_at",
    *raw.DAY_FOLDERS,
)


@query(sql.LANDED)
def bronze_landing(spark, sf_dir):
    path = scratch_path(spark, "landing")
    raw.land(feeds.arrivals(spark, sf_dir), path, "_ingested_at")
    return raw.read_feed(spark, path, feed_schema("arrivals")).select(*LANDED)


@query(f"""
select 2 * count(*) as rows_in, cast(2 * count(*) filter ({sql.K} = 0) as bigint) as without_line,
  count(*) filter ({sql.K} <> 0) as rows_out from events""")
def job_metrics(spark, sf_dir):
    """Counts before and after cleaning, taken during the one write of the job."""
    bronze, seen = observed(
        feeds.arrivals(spark, sf_dir), "in", {"without_line": F.count_if(F.col("lineId").isNull())}
    )
    cleaned, kept = observed(silver.arrivals(bronze, AT), "out")
    write_partitioned(cleaned, scratch_path(spark, "metrics"))
    row = (seen.get["rows"], seen.get["without_line"], kept.get["rows"])
    return spark.createDataFrame([row], "rows_in BIGINT, without_line BIGINT, rows_out BIGINT")


@query("""
select event_id, event_type, user_id, '2024-02-01T00:00:00Z' as _ingested_at, 'poller' as _source,
  'feed.events' as _topic from events""")
def metadata_enrich(spark, sf_dir):
    payload = feeds.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return r.with_metadata(payload, "poller", "feed.events", "2024-02-01T00:00:00Z")


@query("""
select 'arrivals' as feed, cast(event_id as varchar) as id,
  case when event_type not in ('signup', 'error') then 'V' || user_id
    when event_type = 'signup' then sha1('{"event_id":' || event_id || ',"event_type":"signup","user_id":' || user_id || ',"vehicleId":""}')
    else sha1('{"event_id":' || event_id || ',"event_type":"error","user_id":' || user_id || '}') end as key
from events
union all
select 'stoppoints', cast(c_custkey as varchar), case when c_mktsegment = 'BUILDING' then 'S' || c_custkey
  when c_mktsegment = 'MACHINERY' then 'unknown' else 'C' || c_custkey end from customer
union all
select 'line_status', cast(c_custkey as varchar), case when c_mktsegment = 'BUILDING' then 'unknown' else 'L' || c_custkey end from customer
union all
select 'air_quality', cast(event_id as varchar), strftime(ts, '%Y-%m-%d') from events
union all
select 'bikepoints', cast(s_suppkey as varchar), case when s_suppkey % 3 = 0 then 'unknown' when s_suppkey % 3 = 1 then 'D' || s_suppkey
  else 'B' || s_suppkey end from supplier
union all
select 'accidents', cast(s_suppkey as varchar), case when s_suppkey % 3 = 0 then
  sha1('{"s_name":"' || s_name || '","s_suppkey":' || s_suppkey || '}') else cast(s_suppkey as varchar) end from supplier""")
def message_keys(spark, sf_dir):
    events, customer = feeds.table(spark, sf_dir, "events"), feeds.table(spark, sf_dir, "customer")
    kind, user, segment = F.col("event_type"), F.col("user_id"), F.col("c_mktsegment")
    vehicle = F.when(kind == "signup", "").when(kind != "error", feeds.text("V", user))
    predictions = events.select("event_id", "event_type", "user_id", vehicle.alias("vehicleId"))
    stops = customer.select(
        "c_custkey",
        F.when(segment == "BUILDING", feeds.text("S", F.col("c_custkey"))).when(segment == "HOUSEHOLD", "").alias("naptanId"),
        F.when(segment != "MACHINERY", feeds.text("C", F.col("c_custkey"))).alias("id"),
    )
    lines = customer.select("c_custkey", F.when(segment != "BUILDING", feeds.text("L", F.col("c_custkey"))).otherwise("").alias("id"))
    readings = events.select("event_id", feeds.iso(F.col("ts"), "Z").alias("_ingested_at"))
    supplier = feeds.table(spark, sf_dir, "supplier")
    third, own = F.col("s_suppkey") % 3, F.col("s_suppkey")
    docks = supplier.select(
        "s_suppkey", F.when(third == 2, feeds.text("B", own)).when(third == 1, "").alias("id"),
        F.when(third == 1, feeds.text("D", own)).alias("stationId"),
    )
    accidents = supplier.select("s_suppkey", "s_name", F.when(third != 0, own).alias("id"))
    parts = (
        ("arrivals", predictions, "event_id"), ("stoppoints", stops, "c_custkey"), ("line_status", lines, "c_custkey"),
        ("air_quality", readings, "event_id"), ("bikepoints", docks, "s_suppkey"), ("accidents", accidents, "s_suppkey"),
    )
    return r.union_batches([
        df.select(F.lit(feed).alias("feed"), F.col(own).cast("string").alias("id"), r.message_key(df, feed).alias("key"))
        for feed, df, own in parts
    ])


@query("""
select coalesce('U' || user_id, 'unknown') as key,
  '{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":"' || replace(props, '"', '\\"') || '","user_id":' || user_id || '}' as value
from events""")
def to_records(spark, sf_dir):
    payload = feeds.table(spark, sf_dir, "events").select("event_id", "event_type", "props", "user_id")
    return r.to_records(payload, F.coalesce(feeds.text("U", F.col("user_id")), F.lit("unknown")))


@query("""
select conv_id, turn, 'one' as part, text from conversations where role <> 'system'
union all select conv_id, turn, 'two', text from conversations where role = 'assistant'
union all select conv_id, turn, 'inner', text from conversations where role = 'system'""")
def payload_unwrap(spark, sf_dir):
    """User turns arrive as an object, assistant turns as a list, system turns wrapped; a scalar follows each."""
    item = T.StructType.fromDDL("part STRING, text STRING")

    def record(part: str):
        return F.struct(F.lit(part).alias("part"), F.col("text"))

    role = F.col("role")
    body = (
        F.when(role == "user", F.to_json(record("one")))
        .when(role == "assistant", F.to_json(F.array(record("one"), record("two"))))
        .otherwise(F.to_json(F.struct(F.array(record("inner")).alias("stopPoints"), F.lit(1).alias("total"))))
    )
    bodies = feeds.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.explode(F.array(body, F.lit("3"))).alias("value")
    )
    wrapped = r.unwrap_payload(bodies.where(role == "system"), item, wrapper="stopPoints")
    bare = r.unwrap_payload(bodies.where(role != "system"), item)
    return wrapped.unionByName(bare).drop("role")


@query("""
select event_id, event_type, case when event_type in ('click', 'view', 'signup') then user_id end as user_id,
  case when event_type in ('purchase', 'error') then value end as value from events""")
def union_batches(spark, sf_dir):
    events = feeds.table(spark, sf_dir, "events")
    batches = []
    for kind in ("click", "view", "signup", "purchase", "error"):
        extra = "value" if kind in ("purchase", "error") else "user_id"
        batches.append(events.where(F.col("event_type") == kind).select("event_id", "event_type", extra))
    return r.union_batches(batches)


@query(f"""
select cast(event_id as varchar) as id, 'S' || user_id as "naptanId", {sql.LINE_ID} as "lineId", p as poll
from events, (select 'poll 0' as p union all select 'poll 30') where {sql.K} <> 0""")
def filter_required(spark, sf_dir):
    kept = require(feeds.arrivals(spark, sf_dir), ["id", "naptanId", "lineId"])
    return kept.select("id", "naptanId", "lineId", F.trim("currentLocation").alias("poll"))
