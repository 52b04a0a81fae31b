"""Read schemas of the six feeds and the fixed values of the data model.

Feeds are never read with inferred types: a batch holding only empty arrays
would otherwise change the table's schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fields every landed record carries in addition to its payload.
INGEST_FIELDS = "_ingested_at STRING, _source STRING, _topic STRING"

# Payload fields of each feed, as Spark DDL.
FEED_FIELDS = {
    "arrivals": """
        id STRING, operationType INT, vehicleId STRING, naptanId STRING, stationName STRING,
        lineId STRING, lineName STRING, platformName STRING, direction STRING,
        destinationNaptanId STRING, destinationName STRING, timestamp STRING, timeToStation INT,
        currentLocation STRING, towards STRING, expectedArrival STRING, timeToLive STRING,
        modeName STRING""",
    "line_status": """
        id STRING, name STRING, modeName STRING, created STRING, modified STRING,
        lineStatuses ARRAY<STRUCT<id: BIGINT, statusSeverity: INT,
            statusSeverityDescription: STRING, reason: STRING>>""",
    "bikepoints": """
        id STRING, url STRING, commonName STRING, distance DOUBLE, placeType STRING,
        lat DOUBLE, lon DOUBLE, additionalProperties ARRAY<STRUCT<key: STRING, value: STRING>>""",
    "stoppoints": """
        id STRING, naptanId STRING, commonName STRING, placeType STRING, stopType STRING,
        stationNaptan STRING, indicator STRING, stopLetter STRING, status BOOLEAN,
        lat DOUBLE, lon DOUBLE, modes ARRAY<STRING>, lines ARRAY<STRUCT<id: STRING>>,
        additionalProperties ARRAY<STRUCT<key: STRING, value: STRING>>""",
    "air_quality": """
        updatePeriod STRING, updateFrequency STRING, forecastURL STRING, disclaimerText STRING,
        currentForecast ARRAY<STRUCT<forecastType: STRING, forecastID: STRING, fromDate: STRING,
            toDate: STRING, forecastBand: STRING, forecastSummary: STRING, nO2Band: STRING,
            o3Band: STRING, pM10Band: STRING, pM25Band: STRING, sO2Band: STRING,
            forecastText: STRING>>""",
    "accidents": """
        id BIGINT, date STRING, severity STRING, borough STRING, lat DOUBLE, lon DOUBLE,
        location STRING,
        casualties ARRAY<STRUCT<age: INT, class: STRING, severity: STRING, mode: STRING>>,
        vehicles ARRAY<STRUCT<type: STRING, casualties: INT>>""",
}

# Properties of a bike station that become columns.
BIKEPOINT_PROPERTIES = (
    "TerminalName", "Installed", "Locked", "Temporary", "NbBikes", "NbEmptyDocks", "NbDocks",
    "NbStandardBikes", "NbEBikes",
)

# Colour of each line.
LINE_COLOURS = {
    "bakerloo": "#B36305",
    "central": "#E32017",
    "circle": "#FFD300",
    "district": "#00782A",
    "hammersmith-city": "#F3A9BB",
    "jubilee": "#A0A5A9",
    "metropolitan": "#9B0056",
    "northern": "#000000",
    "piccadilly": "#003688",
    "victoria": "#0098D4",
    "waterloo-city": "#95CDBA",
    "dlr": "#00A4A7",
    "elizabeth": "#6950A1",
    "london-overground": "#EE7C0E",
    "tfl-rail": "#0019A8",
    "bus": "#E1251B",
}

# Inclusive hour bands of the day; every other hour is "Night".
HOUR_BANDS = (
    (5, 8, "Early Morning"),
    (9, 11, "Morning"),
    (12, 13, "Lunch"),
    (14, 16, "Afternoon"),
    (17, 19, "Evening Rush"),
    (20, 22, "Evening"),
    (23, 23, "Late Night"),
)
OTHER_HOURS = "Night"
PEAK_HOURS = ((7, 9), (17, 19))

# Inclusive severity bands; every other code is "Severe".
GOOD_SERVICE = 10
SEVERITY_BANDS = ((10, 10, "Normal"), (6, 9, "Minor"), (3, 5, "Major"))
OTHER_SEVERITY = "Severe"
UNKNOWN_SEVERITY = "Unknown"

# Message-key columns of each feed, in order of preference.
MESSAGE_KEYS = {
    "arrivals": ("vehicleId",),
    "line_status": ("id", "lineId"),
    "bikepoints": ("id", "stationId"),
    "stoppoints": ("naptanId", "id"),
    "accidents": ("id",),
}
# Feeds whose key falls back to a fingerprint of the record; the others to a word.
FINGERPRINTED = frozenset({"arrivals", "accidents"})
NO_KEY = "unknown"


def feed_schema(feed: str, ingested: bool = True) -> T.StructType:
    """Read schema of a feed, with the ingest fields unless told otherwise."""
    fields = FEED_FIELDS[feed] + (f", {INGEST_FIELDS}" if ingested else "")
    return T.StructType.fromDDL(" ".join(fields.split()))
