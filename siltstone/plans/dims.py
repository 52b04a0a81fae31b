"""Dimensions of the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.functions.cleaning import banded, normalised, part, with_audit
from siltstone.functions.nested import lookup
from siltstone.functions.timekeys import date_key
from siltstone.operators.dedup import dedup_latest, distinct_values, latest_attributes
from siltstone.operators.surrogate import assign_keys
from siltstone.schemas import (
    GOOD_SERVICE, HOUR_BANDS, LINE_COLOURS, OTHER_HOURS, OTHER_SEVERITY, PEAK_HOURS, SEVERITY_BANDS,
    UNKNOWN_SEVERITY,
)
from siltstone.sources.tables import days, minutes

CREATED = "_created_at"
MINUTES_PER_DAY = 1440


def dim_date(
    spark: SparkSession, first: date, last: date, holidays: DataFrame | None = None, at: str | None = None
) -> DataFrame:
    """Calendar covering every day of the years from ``first`` to ``last``.

    With ``holidays`` (a column ``date``) an ``is_holiday`` flag is added.
    """
    d = F.col("date")
    weekday = F.dayofweek(d)
    df = days(spark, date(first.year, 1, 1), date(last.year, 12, 31)).select(
        d,
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.year(d).alias("year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        weekday.isin(1, 7).alias("is_weekend"),
        (~weekday.isin(1, 7)).alias("is_weekday"),
    )
    if holidays is not None:
        marked = holidays.select(F.col("date").cast("date").alias("date")).distinct().withColumn("_h", F.lit(True))
        df = df.join(marked, "date", "left").withColumn("is_holiday", F.coalesce("_h", F.lit(False))).drop("_h")
    return with_audit(df, CREATED, at)


def dim_time(spark: SparkSession, at: str | None = None) -> DataFrame:
    """One row per minute of the day."""
    hour = F.col("hour")
    peak = [hour.between(low, high) for low, high in PEAK_HOURS]
    df = (
        minutes(spark)
        .withColumn("hour", F.expr("id div 60").cast("int"))
        .withColumn("minute", (F.col("id") % 60).cast("int"))
        .withColumn("time_key", F.col("id").cast("int"))
        .withColumn("time_str", F.concat_ws(":", *(F.lpad(F.col(x).cast("string"), 2, "0") for x in ("hour", "minute"))))
        .withColumn("period_of_day", banded(hour, HOUR_BANDS, OTHER_HOURS))
        .withColumn("is_peak_hour", peak[0] | peak[1])
        .drop("id")
    )
    return with_audit(df, CREATED, at)


def dim_line(line_status: DataFrame, previous: DataFrame | None = None, at: str | None = None) -> DataFrame:
    """Lines, by the newest status reading of each."""
    newest = latest_attributes(line_status, ["id"], ["name", "modeName"], "_ingested_at")
    members = newest.select(
        F.col("id").alias("line_id"), F.col("name").alias("line_name"), F.col("modeName").alias("mode_name")
    )
    df = members.withColumns({
        "line_color": lookup(LINE_COLOURS, "line_id"),
        **{f"is_{mode}": F.col("mode_name") == mode for mode in ("tube", "bus", "dlr")},
        "is_overground": F.col("line_id").contains("overground"),
    })
    return with_audit(assign_keys(df, ["line_id"], "line_key", previous), CREATED, at)


def dim_station(
    stoppoints: DataFrame, arrivals: DataFrame, previous: DataFrame | None = None, at: str | None = None
) -> DataFrame:
    """Stations, with the name under which the newest arrival knows them.

    A stop is known by its ``naptanId``, or where it has none by its ``id``.
    Both sides are reduced to one row per station before they are joined.
    """
    seen = latest_attributes(arrivals, ["naptanId"], ["stationName"], "timestamp")
    names = seen.select(F.col("naptanId").alias("naptan_id"), F.col("stationName").alias("station_name"))
    stops = dedup_latest(
        stoppoints.select(
            F.coalesce("naptanId", "id").alias("naptanId"), "commonName", "stopType", "stationNaptan", "zone", "wifi", "modes", "lat", "lon", "status",
            "_ingested_at",
        ),
        ["naptanId"], ["_ingested_at"],
    ).select(
        F.col("naptanId").alias("naptan_id"), F.col("commonName").alias("common_name"),
        F.col("stopType").alias("stop_type"), F.col("stationNaptan").alias("station_naptan"),
        "zone", "wifi", "modes", "lat", "lon", "status",
    )
    df = stops.join(names, "naptan_id", "left").withColumns({
        "display_name": F.coalesce("station_name", "common_name"),
        "zone_primary": part("zone", "/", 0),
        "zone_secondary": part("zone", "/", 1),
        "has_wifi": F.lower("wifi") == "yes",
    })
    return with_audit(assign_keys(df, ["naptan_id"], "station_key", previous), CREATED, at)


def dim_zone(stoppoints: DataFrame, previous: DataFrame | None = None, at: str | None = None) -> DataFrame:
    """Fare zones; ``2/3`` is a boundary of two."""
    df = distinct_values(stoppoints, "zone").withColumns({
        "zone_primary": part("zone", "/", 0),
        "zone_secondary": part("zone", "/", 1),
        "is_boundary_zone": F.col("zone").contains("/"),
    })
    keyed = assign_keys(df, ["zone"], "zone_key", previous)
    return with_audit(keyed.withColumn("zone_description", F.concat(F.lit("Zone "), F.col("zone"))), CREATED, at)


def dim_disruption(line_status: DataFrame, previous: DataFrame | None = None, at: str | None = None) -> DataFrame:
    """Severity codes; a missing code is a member of its own, in band "Unknown"."""
    newest = latest_attributes(line_status, ["statusSeverity"], ["statusSeverityDescription"], "_ingested_at")
    code = F.col("severity_code")
    df = newest.select(
        F.col("statusSeverity").alias("severity_code"),
        F.col("statusSeverityDescription").alias("severity_description"),
    ).withColumns({
        "is_good_service": code == GOOD_SERVICE,
        "is_disrupted": code < GOOD_SERVICE,
        "severity_category": F.when(code.isNull(), UNKNOWN_SEVERITY).otherwise(banded(code, SEVERITY_BANDS, OTHER_SEVERITY)),
    })
    return with_audit(assign_keys(df, ["severity_code"], "disruption_key", previous), CREATED, at)
