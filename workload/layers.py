"""Cleaned tables, dimensions, facts, views, reports and the whole refresh."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F, types as T

from siltstone.functions.timekeys import date_key
from siltstone.operators import states
from siltstone.operators.quality import (
    Expectations, health_of_profiles, health_report as report_health, profile, quality_report as report_quality,
)
from siltstone.operators.records import union_batches
from siltstone.operators.starjoin import Lookup, star_join
from siltstone.plans import dims, facts, refresh, silver, views
from siltstone.schemas import feed_schema
from siltstone.session import materialise, scratch_path
from siltstone.sources import feeds as raw
from siltstone.sources.commits import quarantined
from siltstone.sources.sinks import write_partitioned
from siltstone.sources.tables import read_table
from workload import feeds, sql
from workload.registry import AT, query


def cleaned_at(spark, sf_dir, feed):
    """Where a cleaned table lies as a job would leave it: written in day folders."""
    path = scratch_path(spark, feed)
    write_partitioned(silver.build(silver.TABLES[feed], feeds.FEEDS[feed](spark, sf_dir), AT), path)
    return path


def cleaned(spark, sf_dir, feed):
    return read_table(spark, cleaned_at(spark, sf_dir, feed))


@query(sql.ARRIVALS)
def silver_events(spark, sf_dir):
    return silver.arrivals(feeds.arrivals(spark, sf_dir), AT)


@query(sql.LINE_STATUS)
def silver_line_status(spark, sf_dir):
    return silver.line_status(feeds.line_status(spark, sf_dir), AT)


@query(f"""
select * exclude (rn) from (
  select *, row_number() over (partition by id, _ingested_at order by "statusSeverity" nulls last) as rn
  from ({sql.LINE_STATUS})) where rn = 1""")
def silver_line_status_per_poll(spark, sf_dir):
    return silver.line_status(feeds.line_status(spark, sf_dir), AT, keys=("id", "_ingested_at"))


@query(sql.BIKEPOINTS)
def silver_bikepoint(spark, sf_dir):
    # Written first, in the even files that the feed comes in: an array built in the
    # same plan would be built again for each property taken from it.
    landed = materialise(feeds.bikepoints(spark, sf_dir), "bikepoints")
    return silver.bikepoints(landed, AT)


@query(sql.STOPPOINTS)
def silver_stoppoint(spark, sf_dir):
    return silver.stoppoints(feeds.stoppoints(spark, sf_dir), AT)


@query(sql.AIR_QUALITY)
def silver_airquality(spark, sf_dir):
    return silver.air_quality(feeds.air_quality(spark, sf_dir), AT)


@query(sql.ACCIDENTS)
def silver_accidents(spark, sf_dir):
    return silver.accidents(feeds.accidents(spark, sf_dir), AT)


CALENDAR = """
select cast(d as date) as date, cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as full_date,
  cast(dayofweek(d) + 1 as integer) as day_of_week, strftime(d, '%A') as day_name,
  cast(day(d) as integer) as day_of_month, cast(dayofyear(d) as integer) as day_of_year,
  cast(weekofyear(d) as integer) as week_of_year, cast(month(d) as integer) as month_number,
  strftime(d, '%B') as month_name, strftime(d, '%b') as month_short, cast(quarter(d) as integer) as quarter,
  'Q' || quarter(d) as quarter_name, cast(year(d) as integer) as year, strftime(d, '%Y-%m') as year_month,
  dayofweek(d) in (0, 6) as is_weekend, dayofweek(d) not in (0, 6) as is_weekday
from (select unnest(generate_series(
  date_trunc('year', (select min(o_orderdate) from orders)),
  date_trunc('year', (select max(o_orderdate) from orders)) + interval 1 year - interval 1 day, interval 1 day)) as d)
"""


@query(f"""
select c.*, h.day is not null as is_holiday, {sql.STAMP} as _created_at, coalesce(o.orders, 0) as orders
from ({CALENDAR}) c
left join (select distinct cast(o_orderdate as date) as day from orders where o_totalprice > 495000) h on c.date = h.day
left join (select {sql.date_key('o_orderdate')} as k, count(*) as orders from orders group by 1) o on c.date_key = o.k""")
def dim_date(spark, sf_dir):
    """The calendar of the years that orders cover, with the orders of each day."""
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    span = refresh.covered_days(orders.select(F.col("o_orderdate").cast("timestamp")))
    holidays = orders.where("o_totalprice > 495000").select(F.to_date("o_orderdate").alias("date"))
    calendar = dims.dim_date(spark, *span, holidays, AT)
    per_day = orders.groupBy(date_key("o_orderdate").alias("date_key")).agg(F.count(F.lit(1)).alias("orders"))
    return calendar.join(per_day, "date_key", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query(f"""
select cast(m // 60 as integer) as hour, cast(m % 60 as integer) as minute, cast(m as integer) as time_key,
  strftime(t, '%H:%M') as time_str, {sql.hours('t')} as period_of_day, {sql.peak('t')} as is_peak_hour,
  {sql.STAMP} as _created_at, coalesce(n, 0) as events
from (select m, timestamp '2024-01-01' + to_minutes(m) as t from (select unnest(range(1440)) as m))
left join (select {sql.time_key('ts')} as k, count(*) as n from events group by 1) on m = k""")
def dim_time(spark, sf_dir):
    """Minutes of the day, with the events of each."""
    events = facts.with_time_keys(feeds.table(spark, sf_dir, "events").select("ts"), "ts")
    per_minute = events.groupBy("time_key").agg(F.count(F.lit(1)).alias("events"))
    return dims.dim_time(spark, AT).join(per_minute, "time_key", "left").withColumn("events", F.coalesce("events", F.lit(0)))


@query(sql.DIM_LINE)
def dim_line(spark, sf_dir):
    return dims.dim_line(silver.line_status(feeds.line_status(spark, sf_dir), AT), at=AT)


@query(sql.DIM_STATION)
def dim_station(spark, sf_dir):
    stops = silver.stoppoints(feeds.stoppoints(spark, sf_dir), AT)
    return dims.dim_station(stops, silver.arrivals(feeds.arrivals(spark, sf_dir), AT), at=AT)


@query(sql.DIM_ZONE)
def dim_zone(spark, sf_dir):
    return dims.dim_zone(silver.stoppoints(feeds.stoppoints(spark, sf_dir), AT), at=AT)


@query(sql.DIM_DISRUPTION)
def dim_disruption(spark, sf_dir):
    return dims.dim_disruption(silver.line_status(feeds.line_status(spark, sf_dir), AT), at=AT)


def orders_star(spark, sf_dir):
    orders = feeds.table(spark, sf_dir, "orders").withColumn("date_key", date_key("o_orderdate"))
    span = refresh.covered_days(orders.select(F.col("o_orderdate").cast("timestamp")))
    calendar = dims.dim_date(spark, *span)
    days = (span[1].year - span[0].year + 1) * 366
    customer = feeds.table(spark, sf_dir, "customer")
    nation = feeds.table(spark, sf_dir, "nation")
    star = star_join(
        orders,
        [
            Lookup(calendar, "date_key", "date_key", ("day_name", "quarter_name", "is_weekend"), row_bound=days),
            Lookup(customer, "o_custkey", "c_custkey", ("c_mktsegment", "c_nationkey")),
            Lookup(nation, "c_nationkey", "n_nationkey", ("n_name",)),
        ],
        grain=["o_orderkey"],
    )
    return star.select(
        "o_orderkey", "date_key", "day_name", "quarter_name", "is_weekend",
        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), "o_orderstatus", "o_totalprice",
    )


@query(f"""
select o_orderkey, {sql.date_key('o_orderdate')} as date_key, strftime(o_orderdate, '%A') as day_name,
  'Q' || quarter(o_orderdate) as quarter_name, dayofweek(o_orderdate) in (0, 6) as is_weekend,
  c_mktsegment as segment, n_name as nation, o_orderstatus, o_totalprice
from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey""")
def fact_orders(spark, sf_dir):
    return orders_star(spark, sf_dir)


def arrivals_fact(spark, sf_dir):
    arrivals, lines, stops = (cleaned(spark, sf_dir, f) for f in ("arrivals", "line_status", "stoppoints"))
    line = materialise(dims.dim_line(lines, at=AT), "dim_line")
    station = materialise(dims.dim_station(stops, arrivals, at=AT), "dim_station")
    return facts.fact_arrivals(arrivals, dims.dim_time(spark, AT), line, station, AT)


def status_fact(spark, sf_dir):
    lines = cleaned(spark, sf_dir, "line_status")
    line = materialise(dims.dim_line(lines, at=AT), "dim_line")
    disruption = materialise(dims.dim_disruption(lines, at=AT), "dim_disruption")
    return facts.fact_line_status(lines, dims.dim_time(spark, AT), line, disruption, AT)


@query(sql.FACT_ARRIVALS)
def fact_events(spark, sf_dir):
    return arrivals_fact(spark, sf_dir)


@query(sql.FACT_LINE_STATUS)
def fact_line_status(spark, sf_dir):
    return status_fact(spark, sf_dir)


@query(f"""
with f as ({sql.ARRIVALS}) select id, "naptanId", "lineId", "timestamp" from f
where "timestamp" > (select max("timestamp") from f) - interval 1 hour""")
def view_last_hour(spark, sf_dir):
    path = cleaned_at(spark, sf_dir, "arrivals")
    return views.last_hours(read_table(spark, path), "timestamp", path=path).select("id", "naptanId", "lineId", "timestamp")


@query(f"""
select line_id, count(*) as snapshots, count(*) filter (is_good_service) as good_snapshots,
  count(*) filter (is_disrupted) as disrupted_snapshots, count(*) filter (is_good_service) / count(*) as good_share,
  min(status_severity) as worst_severity from ({sql.FACT_LINE_STATUS}) group by line_id""")
def view_line_performance(spark, sf_dir):
    return views.line_performance(status_fact(spark, sf_dir))


@query(f"""
select naptan_id, period_of_day, count(*) as arrivals, count(distinct vehicle_id) as vehicles,
  count(distinct line_id) as lines, avg(time_to_station_seconds) as mean_wait_seconds
from ({sql.FACT_ARRIVALS}) group by naptan_id, period_of_day""")
def view_station_activity(spark, sf_dir):
    return views.station_activity(arrivals_fact(spark, sf_dir))


def _checks(rows):
    return "select " + " union all select ".join(
        f"'{check}' as \"check\", '{column}' as \"column\", cast(({failed}) as bigint) as failed, "
        f"cast(({total}) as bigint) as total, ({failed}) = 0 as passed" for check, column, failed, total in rows
    )


def _count(condition, table):
    return f"select count(*) from {table}" + (f" where {condition}" if condition else "")


LINEITEM_KEYS = "l_orderkey, l_linenumber"


@query(_checks([
    ("not_null", "l_orderkey", _count("l_orderkey is null", "lineitem"), _count("", "lineitem")),
    ("not_null", "l_returnflag", _count("l_returnflag is null", "lineitem"), _count("", "lineitem")),
    ("schema", "l_quantity", "1", _count("", "lineitem")),
    *(("schema", x, "0", _count("", "lineitem")) for x in ("l_orderkey", "l_linenumber", "l_returnflag")),
    ("unique", "l_orderkey,l_linenumber",
     f"(select count(*) from lineitem) - (select count(*) from (select distinct {LINEITEM_KEYS} from lineitem))",
     _count("", "lineitem")),
]) + f"""
union all select 'timestamp', 'timeToLive', 2 * count(*) filter (event_type = 'error' and {sql.K} is not null), 2 * count(*),
  count(*) filter (event_type = 'error' and {sql.K} is not null) = 0 from events
union all select 'not_null', 'lineId', 2 * count(*) filter ({sql.K} = 0), 2 * count(*), count(*) filter ({sql.K} = 0) = 0 from events""")
def quality_report(spark, sf_dir):
    items = feeds.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    wanted = T.StructType.fromDDL("l_orderkey BIGINT, l_linenumber INT, l_quantity INT, l_returnflag STRING")
    expect = Expectations(("l_orderkey", "l_returnflag"), ("l_orderkey", "l_linenumber"), schema=wanted)
    predictions = Expectations(("lineId",), timestamps=("timeToLive",))
    return union_batches([report_quality(items, expect), report_quality(feeds.arrivals(spark, sf_dir), predictions)])


@query(f"""
select 'arrivals' as "table", count(*) as rows, max(_ingested_at) as newest, cast(1 as double) as pass_rate from ({sql.ARRIVALS})
union all
select 'line_status', count(*), max(_ingested_at), 2 / 3 from ({sql.LINE_STATUS})
union all
select 'customer', count(*), null, 1 from customer""")
def health_report(spark, sf_dir):
    return report_health({
        "arrivals": (cleaned(spark, sf_dir, "arrivals"), "_ingested_at", Expectations(("id", "naptanId"), ("id", "timestamp"))),
        "line_status": (
            cleaned(spark, sf_dir, "line_status"), "_ingested_at",
            Expectations(("id", "modified"), ("id", "_ingested_at", "statusSeverity")),
        ),
        "customer": (feeds.table(spark, sf_dir, "customer"), None, Expectations(("c_name",), ("c_custkey",))),
    })


EXPECTED = {
    "arrivals": Expectations(("id", "naptanId"), ("id", "timestamp")),
    "line_status": Expectations(("id", "modified"), ("id", "_ingested_at", "statusSeverity")),
}


def halves(df):
    """A table's rows in two parts by their day: those of even days and the others."""
    even = F.col("_day") % 2 == 0
    return df.where(~even), df.where(even)


@query(f"""
select 'arrivals' as "table", count(*) as rows, max(_ingested_at) as newest, cast(1 as double) as pass_rate from ({sql.ARRIVALS})
union all
select 'line_status', count(*), max(_ingested_at), 2 / 3 from ({sql.LINE_STATUS})""")
def health_from_profiles(spark, sf_dir):
    """Health merged from the profiles of day folders, half of which came later; only these are then read."""
    merged = {}
    for name, expect in EXPECTED.items():
        path, kept = scratch_path(spark, name), scratch_path(spark, "profiles")
        for part, mode in zip(halves(cleaned(spark, sf_dir, name)), ("overwrite", "append")):
            write_partitioned(part, path, mode=mode)
            states.keep_states(spark, path, kept, lambda rows, days: profile(rows, expect, days, "_ingested_at"))
        merged[name] = (states.read_states(spark, kept), expect)
    return health_of_profiles(merged)


@query(f"""
select naptan_id, period_of_day, count(*) as arrivals, count(distinct vehicle_id) as vehicles,
  count(distinct line_id) as lines, avg(time_to_station_seconds) as mean_wait_seconds
from ({sql.FACT_ARRIVALS}) group by naptan_id, period_of_day""")
def view_station_kept(spark, sf_dir):
    """The view from states kept by day; a second part of the fact brings other days."""
    path, kept = scratch_path(spark, "fact"), scratch_path(spark, "stations")
    for part, mode in zip(halves(arrivals_fact(spark, sf_dir)), ("overwrite", "append")):
        write_partitioned(part, path, mode=mode)
        states.keep_states(spark, path, kept, views.station_states)
    return views.merged_stations(states.read_states(spark, kept))


def landed_feeds(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    for feed, shape in feeds.FEEDS.items():
        # Feeds of many days come dealt by day, the others have few.
        raw.land(shape(spark, sf_dir), f"{root}/{feed}", "_ingested_at", filed=True)
    return root


STAR_TABLES = {
    **sql.SILVER,
    "dim_line": sql.DIM_LINE, "dim_station": sql.DIM_STATION, "dim_zone": sql.DIM_ZONE,
    "dim_disruption": sql.DIM_DISRUPTION, "fact_arrivals": sql.FACT_ARRIVALS, "fact_line_status": sql.FACT_LINE_STATUS,
}


@query(" union all ".join(f"select '{name}' as name, count(*) as rows from ({text})" for name, text in STAR_TABLES.items())
       + " union all select 'dim_date', 366 union all select 'dim_time', 1440")
def build_star(spark, sf_dir):
    """All layers from landed JSON."""
    bronze, out = landed_feeds(spark, sf_dir), scratch_path(spark, "star")
    paths = refresh.refresh(spark, bronze, f"{out}/silver", f"{out}/gold", at=AT)
    return union_batches([
        read_table(spark, path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, path in paths.items()
    ])


@query(sql.ARRIVALS)
def backfill_range(spark, sf_dir):
    """Half a month is cleaned first; a backfill then redoes part of it and adds the rest."""
    bronze, path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    raw.land(feeds.arrivals(spark, sf_dir), bronze, "_ingested_at")
    early = raw.read_feed(spark, bronze, feed_schema("arrivals"), last=date(2024, 1, 15))
    write_partitioned(silver.arrivals(early, AT), path)
    for _ in range(2):
        refresh.backfill(spark, "arrivals", bronze, path, date(2024, 1, 10), date(2024, 12, 31), at=AT)
    return read_table(spark, path)


def deliveries(spark, sf_dir, bronze, *wanted):
    """Land feeds in two deliveries; after each the tables can be brought up to date.

    Second readings, corrections and half of the lines and stops come with the second.
    """
    later = {
        "arrivals": F.col("currentLocation").contains("30") | (F.crc32(F.col("id").cast("binary")) % 2 == 0),
        "line_status": F.crc32(F.col("id").cast("binary")) % 2 == 0,
    }
    shaped = {feed: materialise(feeds.FEEDS[feed](spark, sf_dir), feed, wide=True) for feed in wanted}
    for delivery in (0, 1):
        for feed, df in shaped.items():
            second = later.get(feed, F.xxhash64(*df.columns[:2]) % 2 == 0)
            raw.land(df.where(second if delivery else ~second), f"{bronze}/{feed}", "_ingested_at")
        yield delivery


FACT_WITHOUT_KEYS = f"""
select * exclude (line_key, station_key), line_key is not null as has_line, station_key is not null as has_station
from ({sql.FACT_ARRIVALS})"""


@query(FACT_WITHOUT_KEYS)
def refresh_incremental(spark, sf_dir):
    """The fact after two runs that each took in only what was new; keys are numbered in order of arrival."""
    bronze, out = scratch_path(spark, "bronze"), scratch_path(spark, "star")
    for _ in deliveries(spark, sf_dir, bronze, "arrivals", "line_status", "stoppoints"):
        refresh.refresh_new(spark, bronze, f"{out}/silver", f"{out}/gold", at=AT)
    fact = read_table(spark, refresh.table_paths(f"{out}/silver", f"{out}/gold")["fact_arrivals"])
    keys = {f"has_{x}": F.col(f"{x}_key").isNotNull() for x in ("line", "station")}
    return fact.withColumns(keys).drop("line_key", "station_key")


@query(f"""
select 'row' as kind, cast(event_id as varchar) as id, 'cleaned' as reason from events where {sql.K} <> 0
union all
select 'line', case when p = 1 then '{{"id": "cut ' || event_id else cast(event_id as varchar) end,
  case when p = 1 then 'unparsed' else 'incomplete' end
from events, (select 0 as p union all select 1) where case when p = 1 then event_type = 'error' else {sql.K} = 0 end""")
def refresh_with_quarantine(spark, sf_dir):
    """Lines that are cut off and records without a line are set aside by the run that takes in the others."""
    bronze, path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    predictions = feeds.arrivals(spark, sf_dir).where(F.col("currentLocation").endswith("poll 0"))
    raw.land(predictions, bronze, "_ingested_at")
    cut = feeds.table(spark, sf_dir, "events").where("event_type = 'error'").select(
        feeds.text('{"id": "cut ', F.col("event_id")).alias("value"), *raw_day("ts")
    )
    cut.write.mode("append").partitionBy(*raw.DAY_FOLDERS).text(bronze)
    for _ in range(2):
        refresh.take_in(spark, "arrivals", bronze, path, AT)
    aside = quarantined(spark, path)
    name = F.when(F.col("reason") == "incomplete", F.get_json_object("line", "$.id")).otherwise(F.col("line"))
    return union_batches([
        read_table(spark, path).select(F.lit("row").alias("kind"), "id", F.lit("cleaned").alias("reason")),
        aside.select(F.lit("line").alias("kind"), name.alias("id"), "reason"),
    ])


def raw_day(time):
    """Day folders of the raw layer from a time column."""
    return [F.date_format(time, fmt).alias(name) for name, fmt in zip(raw.DAY_FOLDERS, ("yyyy", "MM", "dd"))]
