"""Raw feeds to cleaned tables.

A table is a stateless cleaning step, which batch and streaming share, followed
by deduplication and the audit and partition columns.  Required-field filters
are part of the cleaning, so rejected rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions import cleaning as c, nested as n
from siltstone.operators.dedup import dedup_latest
from siltstone.schemas import BIKEPOINT_PROPERTIES
from siltstone.sources.feeds import CORRUPT, DAY_FOLDERS, FILE

PROCESSED = "_silver_processed_at"
INGESTED = "_ingested_at"


@dataclass(frozen=True)
class SilverTable:
    """A cleaned table: how its rows are made, told apart, filed and kept.

    Of the copies of a key the one with the greatest ``newest`` survives, then
    the one with the lowest ``lowest``.
    """

    clean: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    time: str
    #: Condition on a raw record without which cleaning leaves no row of it.
    complete: str
    newest: tuple[str, ...] = ()
    lowest: tuple[str, ...] = ()
    finish: Callable[[DataFrame], DataFrame] | None = None
    append: bool = False

    @property
    def filed_by_key(self) -> bool:
        """Whether a key always belongs to the same day folder."""
        return self.time in self.keys


def finish(df: DataFrame, table: SilverTable, at: str | None = None) -> DataFrame:
    """Final touches on surviving rows: costly text work, audit and partition columns."""
    if table.finish is not None:
        df = table.finish(df)
    own = [x for x in df.columns if x != INGESTED]
    stamped = c.with_partition_columns(c.with_audit(df, PROCESSED, at), table.time)
    return stamped.select(*own, INGESTED, PROCESSED, *c.PARTITION_COLUMNS)


def with_days(table: SilverTable, bronze: DataFrame) -> DataFrame:
    """All cleaned readings of a feed under their day folders, copies included."""
    return c.with_partition_columns(table.clean(bronze), table.time)


def _unparsed() -> Column:
    return F.col(CORRUPT).isNotNull()


def _complete(table: SilverTable) -> Column:
    return F.coalesce(F.expr(table.complete), F.lit(False))


def _set_aside(table: SilverTable) -> Column:
    return _unparsed() | ~_complete(table)


def _fields(marked: DataFrame) -> list[str]:
    return [c for c in marked.columns if c not in (CORRUPT, FILE)]


def _line(marked: DataFrame) -> Column:
    """A record's text: as it was where it did not parse."""
    return F.coalesce(CORRUPT, F.to_json(F.struct(*(F.col(f"`{x}`") for x in _fields(marked) if x not in DAY_FOLDERS))))


def route(table: SilverTable, marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Part records read with their corrupt text and file: those to clean, and (line, reason, file) to set aside.

    A record of which some fields parsed is cleaned with these, and its line is set aside as well.
    """
    bad = marked.where(_set_aside(table)).select(
        _line(marked).alias("line"), F.when(_unparsed(), "unparsed").otherwise("incomplete").alias("reason"), F.col(FILE).alias("file")
    )
    return marked.where(_complete(table)).select(*(F.col(f"`{x}`") for x in _fields(marked))), bad


def lines_aside(table: SilverTable, marked: DataFrame) -> Column:
    """An aggregate: how many records ``route`` sets aside. It looks at whole records, as their lines do."""
    return F.count(F.when(_set_aside(table), _line(marked)))


def build(table: SilverTable, bronze: DataFrame, at: str | None = None) -> DataFrame:
    """The cleaned table of a feed read with its declared schema.

    ``at`` fixes the processing time, for reruns that must agree.
    """
    return finish(dedup_latest(table.clean(bronze), table.keys, table.newest, table.lowest), table, at)


def clean_arrivals(bronze: DataFrame) -> DataFrame:
    df = c.require(bronze, ["id", "naptanId", "lineId"]).select(
        "id", "operationType", "vehicleId", "naptanId", "stationName", "lineId", "lineName",
        "platformName", "direction", "destinationNaptanId", "destinationName", "timestamp",
        "timeToStation", "currentLocation", "towards", "expectedArrival", "timeToLive", "modeName", INGESTED,
    )
    df = c.with_timestamps(df, ["timestamp", "expectedArrival", "timeToLive", INGESTED])
    df = c.with_trimmed(df, ["stationName", "destinationName", "currentLocation", "towards"])
    return c.with_normalised(df, ["direction"])


def clean_line_status(bronze: DataFrame) -> DataFrame:
    lines = c.require(bronze, ["id"]).select("id", "name", "modeName", "lineStatuses", "created", "modified", INGESTED)
    df = n.explode_items(lines, "lineStatuses", "status").select(
        "id", "name", "modeName",
        F.col("status.statusSeverity").try_cast("int").alias("statusSeverity"),
        "status.statusSeverityDescription", "status.reason", "created", "modified", INGESTED,
    )
    df = c.with_timestamps(df, ["created", "modified", INGESTED])
    return c.with_normalised(c.with_trimmed(df, ["name"]), ["modeName"])


def clean_bikepoints(bronze: DataFrame) -> DataFrame:
    df = c.require(bronze, ["id"]).select(
        "id", "commonName", "placeType", "lat", "lon", INGESTED,
        *n.property_columns("additionalProperties", BIKEPOINT_PROPERTIES),
    )
    counts = [p.lower() for p in BIKEPOINT_PROPERTIES if p.startswith("Nb")]
    df = c.with_types(df, {
        "lat": "double", "lon": "double",
        **dict.fromkeys(counts, "int"),
        **dict.fromkeys(("installed", "locked", "temporary"), "boolean"),
    })
    return c.with_timestamps(df, [INGESTED])


def clean_stoppoints(bronze: DataFrame) -> DataFrame:
    """A stop without ``id`` is identified by its ``naptanId``."""
    df = bronze.select(
        F.coalesce("id", "naptanId").alias("id"),
        "naptanId", "commonName", "placeType", "stopType", "stationNaptan", "indicator", "stopLetter",
        "status", "lat", "lon",
        n.property_value("additionalProperties", "Zone").alias("zone"),
        n.property_value("additionalProperties", "WiFi").alias("wifi"),
        F.array_join("modes", ",").alias("modes"),
        INGESTED,
    )
    df = c.with_types(c.require(df, ["id"]), {"status": "boolean", "lat": "double", "lon": "double"})
    return c.with_timestamps(df, [INGESTED])


def clean_air_quality(bronze: DataFrame) -> DataFrame:
    forecasts = n.explode_items(
        bronze.select("updatePeriod", "updateFrequency", "currentForecast", INGESTED), "currentForecast", "forecast"
    )
    df = forecasts.select(
        "updatePeriod", "updateFrequency", "forecast.forecastType",
        F.col("forecast.forecastID").alias("forecastId"),
        "forecast.fromDate", "forecast.toDate", "forecast.forecastBand", "forecast.forecastSummary",
        F.col("forecast.nO2Band").alias("no2Band"),
        F.col("forecast.o3Band").alias("o3Band"),
        F.col("forecast.pM10Band").alias("pm10Band"),
        F.col("forecast.pM25Band").alias("pm25Band"),
        F.col("forecast.sO2Band").alias("so2Band"),
        "forecast.forecastText", INGESTED,
    )
    return c.with_timestamps(c.require(df, ["forecastId"]), ["fromDate", "toDate", INGESTED])


def clean_accidents(bronze: DataFrame) -> DataFrame:
    df = c.require(bronze, ["id"]).select(
        "id", "lat", "lon", "location", "borough", "date", "severity",
        n.join_field("vehicles", "type").alias("vehicle_types"),
        n.count_items("casualties").alias("casualties_total"),
        *(n.count_items_where("casualties", "severity", s).alias(f"casualties_{s}") for s in ("fatal", "serious", "slight")),
        INGESTED,
    )
    df = c.with_timestamps(c.with_types(df, {"lat": "double", "lon": "double"}), ["date", INGESTED])
    return c.with_normalised(c.with_trimmed(df, ["borough", "location"]), ["severity"])


def decode_forecast_text(df: DataFrame) -> DataFrame:
    return df.withColumn("forecastText", c.clean_markup("forecastText"))


def strip_forecast_text(df: DataFrame) -> DataFrame:
    return df.withColumn("forecastText", c.drop_markup("forecastText"))


TABLES = {
    "arrivals": SilverTable(
        clean_arrivals, ("id", "timestamp"), "timestamp", "id is not null and naptanId is not null and lineId is not null", (INGESTED,)
    ),
    "line_status": SilverTable(clean_line_status, ("id", INGESTED, "statusSeverity"), INGESTED, "id is not null"),
    "bikepoints": SilverTable(clean_bikepoints, ("id", INGESTED), INGESTED, "id is not null"),
    "stoppoints": SilverTable(clean_stoppoints, ("id",), INGESTED, "coalesce(id, naptanId) is not null", (INGESTED,)),
    "air_quality": SilverTable(
        clean_air_quality, ("forecastId", "forecastType"), INGESTED, "exists(currentForecast, f -> f.forecastID is not null)",
        (INGESTED,), finish=decode_forecast_text,
    ),
    "accidents": SilverTable(clean_accidents, ("id",), "date", "id is not null", (INGESTED,), append=True),
}


def arrivals(bronze: DataFrame, at: str | None = None) -> DataFrame:
    """Arrival predictions: one row per prediction id and prediction time."""
    return build(TABLES["arrivals"], bronze, at)


def line_status(bronze: DataFrame, at: str | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Line status: one row per line, poll and status.

    With ``keys=("id", "_ingested_at")`` one row per line and poll is kept, the
    one with the lowest severity code.
    """
    table = TABLES["line_status"]
    if keys is not None:
        table = replace(table, keys=tuple(keys), lowest=() if "statusSeverity" in keys else ("statusSeverity",))
    return build(table, bronze, at)


def bikepoints(bronze: DataFrame, at: str | None = None) -> DataFrame:
    """Bike stations: one row per station and poll, its properties as columns."""
    return build(TABLES["bikepoints"], bronze, at)


def stoppoints(bronze: DataFrame, at: str | None = None) -> DataFrame:
    """Stops: the newest reading of each."""
    return build(TABLES["stoppoints"], bronze, at)


def air_quality(bronze: DataFrame, at: str | None = None, decode: bool = True) -> DataFrame:
    """Forecasts: the newest reading of each forecast id and type.

    ``decode=False`` removes entities from the text instead of decoding them.
    """
    table = TABLES["air_quality"]
    return build(table if decode else replace(table, finish=strip_forecast_text), bronze, at)


def accidents(bronze: DataFrame, at: str | None = None) -> DataFrame:
    """Accidents: the newest reading of each, vehicles and casualties folded into columns."""
    return build(TABLES["accidents"], bronze, at)
