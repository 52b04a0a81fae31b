"""Facts of the star schema: cleaned rows with keys into their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.cleaning import PARTITION_COLUMNS, with_audit
from siltstone.functions.timekeys import date_key, time_key
from siltstone.operators.starjoin import Lookup, star_join
from siltstone.plans.dims import MINUTES_PER_DAY
from siltstone.schemas import GOOD_SERVICE

PROCESSED = "_gold_processed_at"


def with_time_keys(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns({"date_key": date_key(time), "time_key": time_key(time)})


def time_lookup(dim_time: DataFrame, *take: str) -> Lookup:
    return Lookup(dim_time, "time_key", "time_key", take, row_bound=MINUTES_PER_DAY)


# The calendar brings no attribute into either fact below: its key is computed
# from the row's own time and kept for days the calendar lacks.  A left join to
# it would change nothing, so the facts carry the key and skip the join.


def fact_arrivals(
    arrivals: DataFrame, dim_time: DataFrame, dim_line: DataFrame, dim_station: DataFrame, at: str | None = None
) -> DataFrame:
    """One row per arrival prediction."""
    joined = star_join(
        with_time_keys(arrivals, "timestamp"),
        [
            time_lookup(dim_time, "period_of_day", "is_peak_hour"),
            Lookup(dim_line, "lineId", "line_id", ("line_key",)),
            Lookup(dim_station, "naptanId", "naptan_id", ("station_key",)),
        ],
        grain=("id", "timestamp"),
    )
    renamed = {
        "id": "arrival_id", "vehicleId": "vehicle_id", "naptanId": "naptan_id", "lineId": "line_id",
        "platformName": "platform_name", "direction": "direction",
        "destinationNaptanId": "destination_naptan_id", "destinationName": "destination_name",
    }
    seconds = F.col("timeToStation")
    return with_audit(
        joined.select(
            "date_key", "time_key", "line_key", "station_key",
            *(F.col(a).alias(b) for a, b in renamed.items()),
            seconds.alias("time_to_station_seconds"),
            (seconds / 60).alias("time_to_station_minutes"),
            F.col("currentLocation").alias("current_location"),
            "towards",
            F.col("modeName").alias("mode_name"),
            F.col("timestamp").alias("prediction_timestamp"),
            F.col("expectedArrival").alias("expected_arrival"),
            F.col("timeToLive").alias("time_to_live"),
            "period_of_day", "is_peak_hour", "_ingested_at", "_silver_processed_at", *PARTITION_COLUMNS,
        ),
        PROCESSED, at,
    )


def fact_line_status(
    line_status: DataFrame, dim_time: DataFrame, dim_line: DataFrame, dim_disruption: DataFrame, at: str | None = None
) -> DataFrame:
    """One row per line-status reading; a missing severity is neither good nor disrupted."""
    joined = star_join(
        with_time_keys(line_status, "_ingested_at"),
        [
            time_lookup(dim_time, "period_of_day", "is_peak_hour"),
            Lookup(dim_line, "id", "line_id", ("line_key",)),
            Lookup(dim_disruption, "statusSeverity", "severity_code", ("disruption_key",)),
        ],
        grain=("id", "_ingested_at", "statusSeverity"),
    )
    severity = F.col("statusSeverity")
    return with_audit(
        joined.select(
            "date_key", "time_key", "line_key", "disruption_key",
            F.col("id").alias("line_id"), F.col("name").alias("line_name"), F.col("modeName").alias("mode_name"),
            severity.alias("status_severity"),
            F.col("statusSeverityDescription").alias("status_description"),
            F.col("reason").alias("disruption_reason"),
            "period_of_day", "is_peak_hour",
            F.coalesce(severity == GOOD_SERVICE, F.lit(False)).alias("is_good_service"),
            F.coalesce(severity < GOOD_SERVICE, F.lit(False)).alias("is_disrupted"),
            "_ingested_at", F.col("modified").alias("last_modified"), *PARTITION_COLUMNS,
        ),
        PROCESSED, at,
    )
