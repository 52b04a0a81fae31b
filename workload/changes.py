"""Upserts, history, schema changes and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions.cleaning import with_partition_columns
from siltstone.operators import merge, surrogate
from siltstone.plans import dims, facts, refresh, silver
from siltstone.schemas import feed_schema
from siltstone.session import materialise, scratch_path
from siltstone.sources import feeds as raw
from siltstone.sources.sinks import write_partitioned
from siltstone.sources.tables import read_table
from siltstone import streaming
from workload import feeds, sql
from workload.layers import cleaned
from workload.registry import AT, query
from workload.sources import LANDED


@query("""
select c_custkey, case when c_mktsegment = 'BUILDING' then c_acctbal * 2 when c_mktsegment = 'MACHINERY' then c_acctbal
    else c_acctbal end as balance,
  case when c_mktsegment = 'BUILDING' then 2 else 1 end as version from customer
union all select c_custkey + 10000000, c_acctbal, 1 from customer where c_mktsegment = 'FURNITURE'""")
def upsert_latest(spark, sf_dir):
    """Newer versions win, older ones lose, unknown keys are added."""
    customer = feeds.table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    target = customer.select("c_custkey", F.col("c_acctbal").alias("balance"), F.lit(1).alias("version"))
    newer = customer.where(segment == "BUILDING").select("c_custkey", (F.col("c_acctbal") * 2).alias("balance"), F.lit(2).alias("version"))
    older = customer.where(segment == "MACHINERY").select("c_custkey", F.lit(-1.0).alias("balance"), F.lit(0).alias("version"))
    added = customer.where(segment == "FURNITURE").select(
        (F.col("c_custkey") + 10_000_000).alias("c_custkey"), F.col("c_acctbal").alias("balance"), F.lit(1).alias("version")
    )
    return merge.upsert_latest(target, newer.unionByName(older).unionByName(added), ["c_custkey"], ["version"])


@query("""
select event_id, case when event_type = 'click' then value + 1 else value end as value,
  case when event_type = 'click' then 2 else 1 end as version,
  cast(year(t) as integer) as _year, cast(month(t) as integer) as _month, cast(day(t) as integer) as _day,
  cast(0 as bigint) as left_in_staging
from (select *, case when event_type = 'click' then ts + to_days(1) else ts end as t from events)""")
def incremental_load(spark, sf_dir):
    """Clicks are corrected to the next day, purchases are new; the staging table ends up empty."""
    events = feeds.table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    kind = F.col("event_type")

    def filed(df):
        return with_partition_columns(df, "ts").select("event_id", "value", "version", "_year", "_month", "_day")

    table, staging = scratch_path(spark, "fact"), scratch_path(spark, "staging")
    write_partitioned(filed(events.where(kind != "purchase").withColumn("version", F.lit(1))), table)
    corrected = events.where(kind == "click").withColumns(
        {"value": F.col("value") + 1, "version": F.lit(2), "ts": feeds.seconds_later(F.col("ts"), F.lit(86400))}
    )
    new = events.where(kind == "purchase").withColumn("version", F.lit(1))
    staged = filed(corrected.unionByName(new))
    staged.write.parquet(staging)
    merge.incremental_load(spark, staging, table, staged.schema, ["event_id"], ["version"])
    left = read_table(spark, staging).agg(F.count(F.lit(1))).scalar()
    return read_table(spark, table).withColumn("left_in_staging", left)


@query("""
select event_id, case when event_type = 'click' then value * 2 else value end as value,
  cast(case when event_type = 'click' then 2 else 1 end as bigint) as version,
  case when event_type = 'click' then 'corrected ' || user_id end as note,
  cast(year(ts) as integer) as _year, cast(month(ts) as integer) as _month, cast(day(ts) as integer) as _day from events""")
def upsert_evolved(spark, sf_dir):
    """A stored table takes over a new column and a wider one."""
    events = feeds.table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    filed = with_partition_columns(events, "ts")
    path = scratch_path(spark, "evolved")
    days = ["_year", "_month", "_day"]
    write_partitioned(filed.select("event_id", "value", F.lit(1).alias("version"), *days), path)
    clicks = filed.where(F.col("event_type") == "click").select(
        "event_id", (F.col("value") * 2).alias("value"), F.lit(2).cast("long").alias("version"),
        feeds.text("corrected ", F.col("user_id")).alias("note"), *days,
    )
    merge.upsert_table(path, clicks, ["event_id"], ["version"], filed_by_key=True)
    return read_table(spark, path)


@query("""
select c_name, c_nationkey, c_mktsegment <> 'MACHINERY' as in_last, true as key_kept from customer""")
def keys_after_refreshes(spark, sf_dir):
    """A dimension built three times: members vanish and appear, every key is given once and kept."""
    members = feeds.table(spark, sf_dir, "customer").select("c_name", "c_nationkey", "c_mktsegment")
    segment = F.col("c_mktsegment")
    runs = [members.where(segment != "BUILDING"), members.where(~segment.isin("BUILDING", "MACHINERY")), members.where(segment != "MACHINERY")]
    keyed, first = None, None
    for run in runs:
        keyed = materialise(surrogate.assign_keys(run.drop("c_mktsegment"), ["c_name"], "customer_key", keyed), "keyed")
        first = first if first is not None else keyed.select("c_name", F.col("customer_key").alias("_first"))
    repeated = keyed.groupBy("customer_key").agg(F.count(F.lit(1)).alias("_n"))
    kept = (F.col("_n") == 1) & F.coalesce(F.col("_first") == F.col("customer_key"), F.lit(True))
    joined = keyed.join(repeated, "customer_key").join(first, "c_name", "left").withColumn("key_kept", kept)
    last = runs[-1].select("c_name", F.lit(True).alias("_last"))
    return joined.join(last, "c_name", "left").select("c_name", "c_nationkey", F.coalesce("_last", F.lit(False)).alias("in_last"), "key_kept")


@query("""
select c_custkey, c_mktsegment as segment, c_nationkey as nation, timestamp '2024-01-01' as valid_from,
  case when c_mktsegment = 'BUILDING' then timestamp '2024-02-01' end as valid_to, c_mktsegment <> 'BUILDING' as is_current
from customer where c_mktsegment <> 'HOUSEHOLD'
union all select c_custkey, 'OLD', c_nationkey, timestamp '2023-01-01', timestamp '2024-01-01', false
from customer where c_mktsegment = 'AUTOMOBILE'
union all select c_custkey, 'REBUILT', c_nationkey, timestamp '2024-02-01', null, true from customer where c_mktsegment = 'BUILDING'
union all select c_custkey, c_mktsegment, c_nationkey, timestamp '2024-02-01', null, true from customer where c_mktsegment = 'HOUSEHOLD'
""")
def scd2_apply(spark, sf_dir):
    """Building customers change, household ones are new, machinery ones are missing from the snapshot."""
    customer = feeds.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")
    )

    def version(df, begin, end, current):
        return df.withColumns({
            "valid_from": F.lit(begin).cast("timestamp"), "valid_to": F.lit(end).cast("timestamp"), "is_current": F.lit(current),
        })

    segment = F.col("segment")
    current = version(customer.where(segment != "HOUSEHOLD"), "2024-01-01", None, True)
    closed = version(customer.where(segment == "AUTOMOBILE").withColumn("segment", F.lit("OLD")), "2023-01-01", "2024-01-01", False)
    snapshot = customer.where(segment != "MACHINERY").withColumn(
        "segment", F.when(segment == "BUILDING", "REBUILT").otherwise(segment)
    )
    return merge.scd2_apply(current.unionByName(closed), snapshot, ["c_custkey"], ["segment", "nation"], "2024-02-01")


@query("""
select user_id, event_type, ts as valid_from, lead(ts) over (partition by user_id order by ts) as valid_to,
  lead(ts) over (partition by user_id order by ts) is null as is_current
from (select *, lag(event_type) over (partition by user_id order by ts) as before from events)
where before is null or before <> event_type""")
def scd2_from_history(spark, sf_dir):
    history = feeds.table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    return merge.scd2_from_history(history, ["user_id"], ["event_type"], "ts")


@query("""
with r as (
  select c_custkey, case when month(t) = 2 and c_mktsegment = 'BUILDING' then 'REBUILT' else c_mktsegment end as segment, t
  from customer, (select unnest([timestamp '2024-01-01', timestamp '2024-02-01', timestamp '2024-03-01']) as t)
  where c_mktsegment <> 'HOUSEHOLD' or month(t) = 2),
v as (select *, lag(segment) over (partition by c_custkey order by t) as before from r)
select c_custkey, segment, t as valid_from, lead(t) over (partition by c_custkey order by t) as valid_to,
  lead(t) over (partition by c_custkey order by t) is null as is_current
from v where before is null or before <> segment""")
def scd2_out_of_order(spark, sf_dir):
    """Snapshots of March, January and February arrive in that order; buildings differ in February, households are in no other."""
    customer = feeds.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    segment, home = F.col("segment"), F.col("segment") == "HOUSEHOLD"
    february = customer.withColumn("segment", F.when(segment == "BUILDING", "REBUILT").otherwise(segment))
    dimension = None
    for month, members in ((3, customer.where(~home)), (1, customer.where(~home)), (2, february)):
        snapshot = members.withColumn("taken", F.lit(f"2024-0{month}-01").cast("timestamp"))
        dimension = materialise(merge.scd2_splice(dimension, snapshot, ["c_custkey"], ["segment"], "taken"), "spliced")
    return dimension.drop(merge.READ_AT)


@query("""
select o_orderkey, cast(o_custkey as bigint) as customer, o_totalprice as price, cast(null as varchar) as priority from orders
union all select o_orderkey, o_custkey, floor(o_totalprice), o_orderpriority from orders where o_orderstatus = 'P'""")
def schema_evolve(spark, sf_dir):
    """Two columns widen and one is new."""
    orders = feeds.table(spark, sf_dir, "orders")
    old = orders.select("o_orderkey", F.col("o_custkey").cast("int").alias("customer"), F.col("o_totalprice").alias("price"))
    new = orders.where("o_orderstatus = 'P'").select(
        "o_orderkey", F.col("o_custkey").alias("customer"), F.floor("o_totalprice").cast("int").alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )
    return merge.schema_evolve(old, new)


def landed(spark, sf_dir, feed="arrivals"):
    path = scratch_path(spark, "bronze")
    raw.land(feeds.FEEDS[feed](spark, sf_dir), path, "_ingested_at", filed=True)
    return path


def checkpoint(spark):
    return scratch_path(spark, "stream-state")


@query(sql.LANDED)
def stream_bronze_landing(spark, sf_dir):
    incoming = scratch_path(spark, "incoming")
    feeds.arrivals(spark, sf_dir).write.options(**raw.LANDED_OPTIONS).json(incoming)
    path = scratch_path(spark, "bronze")
    stream = streaming.read_feed_stream(spark, incoming, feed_schema("arrivals"))
    streaming.land_stream(stream, path, checkpoint(spark), "_ingested_at")
    return raw.read_feed(spark, path, feed_schema("arrivals")).select(*LANDED)


def settled_arrivals(spark, sf_dir, delay="1 hour"):
    """Predictions as a stream, the survivor of each key; one of a later day closes all keys before it and stays open."""
    bronze = landed(spark, sf_dir)
    rows = feeds.arrivals(spark, sf_dir).where("naptanId is not null and lineId is not null")
    # Its time is found first, so that whole records are made and ordered only for rows of that time.
    newest = rows.agg(F.max("timestamp").alias("timestamp"))
    last = rows.join(F.broadcast(newest), "timestamp", "left_semi").orderBy("id").limit(1)
    beat = last.withColumns({"id": F.lit("beat"), "timestamp": feeds.iso(feeds.seconds_later(F.col("timestamp"), F.lit(86400)))})
    raw.land(beat, bronze, "_ingested_at")
    stream = streaming.read_feed_stream(spark, bronze, feed_schema("arrivals"))
    return streaming.settled_stream(silver.TABLES["arrivals"], stream, delay, AT)


@query(sql.ARRIVALS)
def stream_silver_events(spark, sf_dir):
    """As the batch table, row for row."""
    path = scratch_path(spark, "silver")
    streaming.write_available(settled_arrivals(spark, sf_dir), path, checkpoint(spark))
    return read_table(spark, path)


@query(sql.FACT_ARRIVALS)
def stream_fact_events(spark, sf_dir):
    """Facts of streamed predictions, joined batch by batch."""
    arrivals, lines, stops = (cleaned(spark, sf_dir, f) for f in ("arrivals", "line_status", "stoppoints"))
    line = materialise(dims.dim_line(lines, at=AT), "dim_line")
    station = materialise(dims.dim_station(stops, arrivals, at=AT), "dim_station")
    path = scratch_path(spark, "fact")

    def build(batch):
        return facts.fact_arrivals(batch, dims.dim_time(spark, AT), line, station, AT)

    keys = ("arrival_id", "prediction_timestamp")
    streaming.fact_stream(settled_arrivals(spark, sf_dir), build, path, checkpoint(spark), keys, ("_ingested_at",))
    return read_table(spark, path)


@query(sql.ARRIVALS)
def stream_upsert(spark, sf_dir):
    """Cleaned copies are merged into the table, the newest of each key staying."""
    table = silver.TABLES["arrivals"]
    path = scratch_path(spark, "silver")
    stream = streaming.read_feed_stream(spark, landed(spark, sf_dir), feed_schema("arrivals"))
    rows = silver.finish(table.clean(stream), table, AT)
    streaming.upsert_stream(rows, path, checkpoint(spark), table.keys, table.newest, filed_by_key=table.filed_by_key)
    return read_table(spark, path)


@query(f"""
select cast(day(ts) as integer) as day, count(*) as rows,
  count(*) filter (event_type = 'error' and ts <= (select max(ts) from events where event_type <> 'error' and {sql.K} <> 0) - interval 5 days) as late
from events where {sql.K} <> 0 group by day(ts)""")
def stream_late_data(spark, sf_dir):
    """Error events arrive in a second delivery.

    Those older than the watermark are dropped by the stream and come back with
    the backfill, which leaves the table as if nothing had been late.
    """
    bronze, path, state = scratch_path(spark, "bronze"), scratch_path(spark, "silver"), checkpoint(spark)
    table, schema = silver.TABLES["arrivals"], feed_schema("arrivals")
    predictions = feeds.arrivals(spark, sf_dir)
    late = F.col("towards") == "error "
    for delivery in (predictions.where(~late), predictions.where(late)):
        raw.land(delivery, bronze, "_ingested_at")
        rows = streaming.silver_stream(table, streaming.read_feed_stream(spark, bronze, schema), "5 days", AT)
        streaming.upsert_stream(rows, path, state, table.keys, table.newest, filed_by_key=table.filed_by_key)
    in_time = materialise(read_table(spark, path).select("id", F.lit(True).alias("in_time")), "streamed")
    span = refresh.covered_days(predictions.select(F.try_to_timestamp("timestamp").alias("t")))
    refresh.backfill(spark, "arrivals", bronze, path, *span, at=AT)
    return read_table(spark, path).join(in_time, "id", "left").groupBy(F.dayofmonth("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("in_time").isNull()).alias("late")
    )
