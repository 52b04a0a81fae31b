"""The supplied tables reshaped into raw feeds, with re-sent copies and bad values.

Every feed covers its whole table.  Shapes follow ``siltstone.schemas``; each
reshaping is row by row, after one shuffle of the narrow rows of a large table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.operators.records import with_metadata
from siltstone.schemas import LINE_COLOURS, feed_schema

LINE_IDS = list(LINE_COLOURS)
MICROS_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task reshapes.
SPREAD_ROWS = 100_000


def spread(df: DataFrame, by: Column | None = None) -> DataFrame:
    """The same rows dealt evenly over tasks of a bounded size, those of few values of ``by`` in each.

    Tables are compressed and in few splits, and a raw feed is many times as large,
    so rows are dealt while they are narrow: by day, records need no shuffle to land.
    """
    tasks = -(-df.count() // SPREAD_ROWS)
    if tasks <= 1:
        return df
    return df.repartition(tasks, *df.columns) if by is None else df.repartitionByRange(tasks, by, F.xxhash64(*df.columns))


def text(*parts: Column | str) -> Column:
    """Concatenation where bare strings are literals."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def iso(time: Column, suffix: str = "") -> Column:
    return F.concat(F.date_format(time, MICROS_ISO), F.lit(suffix))


def seconds_later(time: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(time.cast("timestamp")) + seconds.cast("long") * 1_000_000)


def events_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the integer held in ``props``; ``ts`` as a zoned timestamp."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    events = spread(
        table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props"), F.to_date("ts")
    )
    return events.withColumns({"k": k, "ts": F.col("ts").cast("timestamp")})


def hour_of_2024(day: Column) -> Column:
    """Seven years of days as consecutive hours, so that a table has a hundred day folders."""
    begin, epoch = F.lit("2024-01-01").cast("timestamp"), F.lit("1995-01-01").cast("date")
    return seconds_later(begin, F.datediff(day, epoch) * 3600)


def line_id(user: Column) -> Column:
    """The first users stand for the lines that have a colour, the others for routes."""
    names = F.array(*(F.lit(x) for x in LINE_IDS))
    return F.coalesce(F.get(names, user.cast("int")), text("route-", user))


def in_schema(df: DataFrame, feed: str) -> DataFrame:
    """The feed's columns in its declared types; columns not given are null."""
    return df.select(
        *((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in feed_schema(feed).fields)
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a prediction seen by two polls 30 seconds apart."""
    e = events_with_k(spark, sf_dir).withColumn("poll", F.explode(F.array(F.lit(0), F.lit(30))))
    kind, user, ts = F.col("event_type"), F.col("user_id"), F.col("ts")
    wait = F.col("k") * 17
    expected = iso(seconds_later(ts, wait), "Z")
    df = e.select(
        F.col("event_id").cast("string").alias("id"),
        F.lit(1).alias("operationType"),
        F.when(kind == "signup", "").when(kind != "error", text("V", user)).alias("vehicleId"),
        text("S", user).alias("naptanId"),
        text("  Station ", user, " ").alias("stationName"),
        F.when(F.col("k") != 0, line_id(user)).alias("lineId"),
        text("Line ", user).alias("lineName"),
        F.when(kind != "view", text("Platform ", kind)).alias("platformName"),
        F.when(kind.isin("click", "view"), " Inbound ").otherwise("OUTBOUND").alias("direction"),
        F.lit("").alias("destinationNaptanId"),
        text(" ", kind, " ").alias("destinationName"),
        iso(ts).alias("timestamp"),
        wait.alias("timeToStation"),
        text(" poll ", F.col("poll")).alias("currentLocation"),
        text(kind, " ").alias("towards"),
        expected.alias("expectedArrival"),
        F.when(kind == "error", "not a time").otherwise(expected).alias("timeToLive"),
        F.when(kind == "purchase", "bus").otherwise("tube").alias("modeName"),
        iso(seconds_later(ts, F.col("poll")), "+00:00").alias("at"),
    )
    return in_schema(with_metadata(df, "arrivals", "feed.arrivals", F.col("at")), "arrivals")


def line_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a poll of one line: none, one or two statuses, by event type."""
    kind, user, ts = F.col("event_type"), F.col("user_id"), iso(F.col("ts"), "Z")
    severity = F.pmod("k", F.lit(12))

    def status(code: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(0).cast("long").alias("id"), code.cast("int").alias("statusSeverity"),
            text("Severity ", code).alias("statusSeverityDescription"), reason.alias("reason"),
        )

    because, none = text("Reason ", F.col("event_id")), F.lit(None).cast("string")
    one = F.array(status(severity, none))
    two = F.array(status(severity, because), status(F.lit(10), none))
    df = events_with_k(spark, sf_dir).select(
        line_id(user).alias("id"),
        text(" Line ", user, " ").alias("name"),
        F.when(user < 11, " TUBE").when(user == 11, "Dlr ").otherwise("bus").alias("modeName"),
        ts.alias("created"),
        F.when(kind != "signup", ts).alias("modified"),
        F.when(kind == "signup", F.slice(one, 1, 0)).when(kind == "error", two).when(kind != "view", one).alias("lineStatuses"),
        ts.alias("at"),
    )
    return in_schema(with_metadata(df, "line_status", "feed.line_status", F.col("at")), "line_status")


def bikepoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item is a reading of the dock its part stands for."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"
    ), F.to_date(hour_of_2024(F.col("l_shipdate"))))
    flag, status, quantity = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity").cast("int")

    def entry(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    given = F.array(
        entry("TerminalName", F.col("l_suppkey")),
        entry("Installed", F.when(flag == "N", "true").when(flag == "A", "false").otherwise("maybe")),
        entry("Locked", F.when(status == "O", "true").otherwise("false")),
        entry("NbBikes", quantity),
        entry("NbEmptyDocks", F.when(flag == "R", "n/a").otherwise((50 - quantity).cast("string"))),
        entry("NbDocks", F.lit(50)),
        entry("NbStandardBikes", F.col("l_linenumber")),
        entry("NbStandardBikes", F.lit(99)),
    )
    properties = F.when(flag == "A", F.concat(given, F.array(entry("Temporary", F.lit("false"))))).otherwise(given)
    df = li.select(
        text("Dock_", F.col("l_partkey")).alias("id"),
        text("Dock ", F.col("l_partkey")).alias("commonName"),
        F.lit("BikePoint").alias("placeType"),
        F.col("l_discount").alias("lat"),
        F.col("l_tax").alias("lon"),
        properties.alias("additionalProperties"),
        iso(hour_of_2024(F.col("l_shipdate")), "Z").alias("at"),
    )
    return in_schema(with_metadata(df, "bikepoints", "feed.bikepoints", F.col("at")), "bikepoints")


STOP_POLLS = ("2024-01-01T03:00:00Z", "2024-01-20T03:00:00Z")


def stoppoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a stop, polled twice with its status turned in between."""
    cust = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")).withColumn("at", F.explode(F.array(*(F.lit(p) for p in STOP_POLLS))))
    segment, nation, key = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_custkey")
    zone = F.when(nation < 10, nation.cast("string")).when(nation <= 20, text(nation - 9, "/", nation - 8))

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    wifi = F.when(segment == "HOUSEHOLD", "yes").when(segment == "MACHINERY", "Yes").when(segment == "FURNITURE", "no")
    df = cust.select(
        F.when(segment != "BUILDING", text("C", key)).alias("id"),
        text("S", key).alias("naptanId"),
        F.col("c_name").alias("commonName"),
        F.lit("StopPoint").alias("placeType"),
        segment.alias("stopType"),
        text("N", nation).alias("stationNaptan"),
        ((F.col("c_acctbal") > 0) == (F.col("at") == STOP_POLLS[1])).alias("status"),
        F.col("c_acctbal").alias("lat"),
        nation.cast("double").alias("lon"),
        F.when(segment != "AUTOMOBILE", F.when(nation < 12, F.array(F.lit("tube"), F.lit("bus"))).otherwise(F.array(F.lit("tube")))).alias("modes"),
        F.filter(F.array(entry("Zone", zone), entry("WiFi", wifi)), lambda p: p.value.isNotNull()).alias("additionalProperties"),
        "at",
    )
    return in_schema(with_metadata(df, "stoppoints", "feed.stoppoints", F.col("at")), "stoppoints")


PAGE_POLLS = ("2024-01-01T00:00:00Z", "2024-01-02T06:00:00Z", "2024-01-03T00:00:00Z")


def air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page is a pair of forecasts: first by its address, then by its markup, then none."""
    pages = table(spark, sf_dir, "pages").withColumn("at", F.explode(F.array(*(F.lit(p) for p in PAGE_POLLS))))
    element = feed_schema("air_quality")["currentForecast"].dataType.elementType

    def forecast(kind: str, body: Column) -> Column:
        given = {
            "forecastType": F.lit(kind), "forecastID": text("F", F.col("page_id")), "fromDate": F.col("at"),
            "toDate": F.lit("tomorrow"), "forecastBand": F.lit("Low"), "nO2Band": F.lit("Low"),
            "pM10Band": F.lit("Moderate"), "forecastText": body,
        }
        return F.struct(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in element.fields))

    def pair(body: Column) -> Column:
        return F.array(forecast("Current", body), forecast("Future", F.col("url")))

    full = pair(F.when(F.col("at") == PAGE_POLLS[0], F.col("url")).otherwise(F.col("html")))
    df = pages.select(
        F.lit("hourly").alias("updatePeriod"),
        F.lit("1").alias("updateFrequency"),
        F.when(F.col("at") == PAGE_POLLS[2], F.slice(full, 1, 0)).otherwise(full).alias("currentForecast"),
        "at",
    )
    return in_schema(with_metadata(df, "air_quality", "feed.air_quality", F.col("at")), "air_quality")


ACCIDENT_POLLS = ("2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z")


def accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is an accident, reported twice with its location corrected."""
    orders = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )).withColumn("at", F.explode(F.array(*(F.lit(p) for p in ACCIDENT_POLLS))))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")

    def casualty(severity: str | None) -> Column:
        return F.struct(
            F.lit(30).alias("age"), F.lit("Driver").alias("class"),
            F.lit(severity).cast("string").alias("severity"), F.lit("Car").alias("mode"),
        )

    def vehicle(kind: str | None) -> Column:
        return F.struct(F.lit(kind).cast("string").alias("type"), F.lit(1).alias("casualties"))

    hurt = F.array(casualty("Fatal"), casualty("slight"), casualty(None), casualty("Slight"))
    df = orders.select(
        F.col("o_orderkey").alias("id"),
        iso(hour_of_2024(F.col("o_orderdate")), "Z").alias("date"),
        text(" ", priority, "  ").alias("severity"),
        text(" Borough ", F.col("o_custkey")).alias("borough"),
        F.col("o_totalprice").alias("lat"),
        text("Near ", F.substring("at", 1, 10), " ").alias("location"),
        F.when(status == "F", hurt).when(status == "O", F.slice(hurt, 1, 0)).alias("casualties"),
        F.when(priority == "1-URGENT", F.array(vehicle("Car"), vehicle(None), vehicle("Bus")))
        .when(priority == "2-HIGH", F.slice(F.array(vehicle("Car")), 1, 0))
        .when(priority != "5-LOW", F.array(vehicle("Pedal Cycle"))).alias("vehicles"),
        "at",
    )
    return in_schema(with_metadata(df, "accidents", "feed.accidents", F.col("at")), "accidents")


FEEDS = {
    "arrivals": arrivals,
    "line_status": line_status,
    "bikepoints": bikepoints,
    "stoppoints": stoppoints,
    "air_quality": air_quality,
    "accidents": accidents,
}
