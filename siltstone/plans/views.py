"""Analytical views over the facts.

``line_states`` and ``station_states`` are for ``operators.states.keep_states``: a
changed day of a fact then costs that day, and the view is merged from the states.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.cleaning import PARTITION_COLUMNS
from siltstone.functions.timekeys import in_days
from siltstone.sources.files import folder_values

MICROS = 1_000_000


def _newest_micros(fact: DataFrame, time: str, path: str | None) -> int | None:
    """Greatest ``time``, found by reading that column of the newest day folders only.

    With the table's ``path`` its folders are listed and no file of another day
    is opened; a folder that holds no row is passed over.
    """
    if path is None:
        folder = fact.agg(F.max(F.struct(*PARTITION_COLUMNS)).alias("f")).first()["f"]
        days = [] if folder is None else [tuple(folder)]
    else:
        days = folder_values(fact.sparkSession, path, PARTITION_COLUMNS)
    for day in reversed(days):
        newest = fact
        for c, value in zip(PARTITION_COLUMNS, day):
            newest = newest.where(F.col(c).eqNullSafe(F.lit(value)))
        micros = newest.agg(F.max(F.unix_micros(time)).alias("t")).first()["t"]
        if micros is not None:
            return micros
    return None


def last_hours(
    fact: DataFrame, time: str, hours: int = 1, as_of: datetime | None = None, path: str | None = None
) -> DataFrame:
    """Rows in ``(as_of - hours, as_of]``; ``as_of`` defaults to the newest row's time.

    ``fact`` is filed by day of ``time``; the range also names the day folders,
    because a predicate on ``time`` alone would not prune them.  ``path`` is where
    the table is kept, to find its newest day by listing.
    """
    if as_of is None:
        end = _newest_micros(fact, time, path)
        if end is None:
            return fact.limit(0)
    else:
        aware = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
        end = (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    begin = end - hours * 3600 * MICROS
    first, last = (datetime.fromtimestamp(t // MICROS, timezone.utc).date() for t in (begin, end))
    at = F.col(time)
    return fact.where(
        in_days(PARTITION_COLUMNS, first, last)
        & (at > F.timestamp_micros(F.lit(begin)))
        & (at <= F.timestamp_micros(F.lit(end)))
    )


def line_states(fact_line_status: DataFrame, folders: Sequence[str] = ()) -> DataFrame:
    """Per folder and line what ``line_performance`` adds up."""
    return fact_line_status.groupBy(*folders, "line_id").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count_if("is_good_service").alias("good_snapshots"),
        F.count_if("is_disrupted").alias("disrupted_snapshots"),
        F.min("status_severity").alias("worst_severity"),
    )


def merged_lines(states: DataFrame) -> DataFrame:
    """``line_performance`` from the states of any folders."""
    counts = ("snapshots", "good_snapshots", "disrupted_snapshots")
    merged = states.groupBy("line_id").agg(*(F.sum(c).alias(c) for c in counts), F.min("worst_severity").alias("worst_severity"))
    return merged.select("line_id", *counts, (F.col("good_snapshots") / F.col("snapshots")).alias("good_share"), "worst_severity")


def line_performance(fact_line_status: DataFrame) -> DataFrame:
    """Per line: readings, how many were good or disrupted, share of good, worst severity."""
    return merged_lines(line_states(fact_line_status))


PLACE = ("naptan_id", "period_of_day")


def station_states(fact_arrivals: DataFrame, folders: Sequence[str] = ()) -> DataFrame:
    """Per folder, station, period, vehicle and line: rows and waits.

    Sums and distinct values at once, so merged states count exactly.
    """
    seconds = F.col("time_to_station_seconds")
    return fact_arrivals.groupBy(*folders, *PLACE, "vehicle_id", "line_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(seconds.cast("long")).alias("seconds"), F.count(seconds).alias("timed")
    )


def merged_stations(states: DataFrame) -> DataFrame:
    """``station_activity`` from the states of any folders."""
    return states.groupBy(*PLACE).agg(
        F.sum("rows").alias("arrivals"),
        F.count_distinct("vehicle_id").alias("vehicles"),
        F.count_distinct("line_id").alias("lines"),
        F.try_divide(F.sum("seconds"), F.sum("timed")).alias("mean_wait_seconds"),
    )


def station_activity(fact_arrivals: DataFrame) -> DataFrame:
    """Per station and period of day: arrivals, vehicles, lines and mean wait.

    Fact rows are folded to one for each vehicle and line before anything is
    counted distinctly, so they are not multiplied by the distinct counts.
    """
    return merged_stations(station_states(fact_arrivals))
