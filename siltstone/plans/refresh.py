"""Whole refresh of the layers, and backfill of a day range."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from siltstone.functions.cleaning import PARTITION_COLUMNS
from siltstone.functions.folders import folders_of, in_folders
from siltstone.functions.matching import same
from siltstone.functions.timekeys import in_days
from siltstone.operators.merge import Settled, replace_rows, upsert_table
from siltstone.operators.starjoin import fits_broadcast
from siltstone.plans import dims, facts, silver
from siltstone.schemas import feed_schema
from siltstone.session import materialise, scratch_scope
from siltstone.sources.commits import BAD, LOG, begin, landed_files, not_taken_in, taken_in
from siltstone.sources.feeds import DAY_FOLDERS, read_feed
from siltstone.sources.files import exists, folder_values
from siltstone.sources.sinks import observed, write_dimension, write_partitioned
from siltstone.sources.tables import read_table, read_table_if_any

DIMENSIONS = ("dim_date", "dim_time", "dim_line", "dim_station", "dim_zone", "dim_disruption")
FACTS = ("fact_arrivals", "fact_line_status")


def routed(table: silver.SilverTable, raw: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Records to clean and what to set aside, from one scan of the landed files."""
    good, bad = silver.route(table, materialise(raw, "landed", wide=True))
    bad = materialise(bad, "bad")
    return good, {} if bad.isEmpty() else {BAD: bad}


def kept_once(
    table: silver.SilverTable, marked: DataFrame, feed: str, at: str | None
) -> tuple[DataFrame, Observation, dict[str, DataFrame]]:
    """The cleaned rows of a whole feed, their count, and what to set aside.

    The records are wide, so they are not written out to be read by both sides: the
    pass that cleans them counts the lines to set aside, and only if there are any
    are the files, as they were listed, read for these. The cleaned rows are written
    out before they are filed, so that the shuffle that finds copies is gone by then.
    """
    watched, aside = observed(marked, f"landed_{feed}", {"aside": silver.lines_aside(table, marked)})
    df, seen = observed(silver.build(table, silver.route(table, watched)[0], at), f"silver_{feed}")
    df = materialise(df, "cleaned")
    return df, seen, {BAD: materialise(silver.route(table, marked)[1], "bad")} if aside.get["aside"] else {}


def refresh_silver(spark: SparkSession, feed: str, bronze: str, path: str, at: str | None = None) -> Observation:
    """Rebuild one cleaned table in a single pass over its feed; the result holds its row count.

    What is landed while it runs may be taken in, but counts as new for the next run.
    """
    table = silver.TABLES[feed]
    with scratch_scope(spark):
        landed = {LOG: materialise(landed_files(spark, bronze), "files")}
        marked = read_feed(spark, bronze, feed_schema(feed), marked=True)
        df, seen, bad = kept_once(table, marked, feed, at)
        if table.append:
            # Rows whose raw data has gone stay; a correction of a known row replaces it.
            upsert_table(path, df, table.keys, table.newest, settled=settling(table), beside=landed | bad, unique=True)
        else:
            replace_rows(path, df, table.keys, filed_by_key=table.filed_by_key, beside=landed | bad)
    return seen


def settling(table: silver.SilverTable) -> Settled:
    """Copies of equal age are settled as a rebuild does, whatever run took them in."""
    return Settled(table.lowest, (silver.PROCESSED,))


def new_records(spark: SparkSession, feed: str, bronze: str, path: str) -> tuple[DataFrame, DataFrame] | None:
    """The records of files that the table has not taken in, and these files; None if there are none.

    Their names come to the driver, as those of any files to be read do; without
    a log the whole feed is read.
    """
    fresh = materialise(not_taken_in(spark, landed_files(spark, bronze), path), "fresh")
    if fresh.isEmpty():
        return None
    names = [r["file"] for r in fresh.select("file").collect()] if taken_in(spark, path) is not None else None
    return read_feed(spark, bronze, feed_schema(feed), files=names, marked=True), fresh


def take_in(spark: SparkSession, feed: str, bronze: str, path: str, at: str | None = None) -> set[str]:
    """Merge what has landed since the last run into a cleaned table; the folders that changed.

    Only new files are opened, and of the table only the folders of the new rows
    and of older readings of their keys.  Rows, log and lines set aside are one
    commit, so a run that stopped is simply run again.
    """
    if not exists(spark, bronze):
        return set()
    table = silver.TABLES[feed]
    begin(spark, path)
    with scratch_scope(spark):
        found = new_records(spark, feed, bronze, path)
        if found is None:
            return set()
        good, bad = routed(table, found[0])
        # The merge drops the copies of keys that have their folders, by the same order.
        merged_once = table.filed_by_key and table.finish is None
        rows = silver.finish(table.clean(good), table, at) if merged_once else silver.build(table, good, at)
        return upsert_table(
            path, rows, table.keys, table.newest, filed_by_key=table.filed_by_key,
            settled=settling(table), beside={LOG: found[1]} | bad, written=True,
        )


def covered_days(times: DataFrame) -> tuple[date, date] | None:
    """First and last day of a one-column frame of times."""
    t = F.unix_micros(times.columns[0])
    first, last = times.agg(F.min(t), F.max(t)).first()
    if first is None:
        return None
    return tuple(datetime.fromtimestamp(x // 1_000_000, timezone.utc).date() for x in (first, last))


def filed_days(spark: SparkSession, *paths: str) -> tuple[date, date] | None:
    """First and last day under which tables keep rows; only folders are listed."""
    days = [d for path in paths for d in folder_values(spark, path, PARTITION_COLUMNS)]
    return (date(*min(days)), date(*max(days))) if days else None


def table_paths(silver_root: str, gold_root: str) -> dict[str, str]:
    """Where each table of the cleaned and the star layer is kept."""
    return {
        **{feed: f"{silver_root}/{feed}" for feed in silver.TABLES},
        **{name: f"{gold_root}/dimensions/{name}" for name in DIMENSIONS},
        **{name: f"{gold_root}/facts/{name}" for name in FACTS},
    }


def cleaned(spark: SparkSession, feed: str, paths: Mapping[str, str], **days: date | None) -> DataFrame:
    """A cleaned table; one without rows if nothing has been taken in yet."""
    if read_table_if_any(spark, paths[feed]) is None:
        return silver.build(silver.TABLES[feed], spark.createDataFrame([], feed_schema(feed)))
    return read_table(spark, paths[feed], **days)


# Dimensions keyed by their members, and the cleaned tables each is built from.
MEMBERS = {
    "dim_line": (dims.dim_line, ("line_status",)),
    "dim_station": (dims.dim_station, ("stoppoints", "arrivals")),
    "dim_zone": (dims.dim_zone, ("stoppoints",)),
    "dim_disruption": (dims.dim_disruption, ("line_status",)),
}

# Facts, the cleaned table each is built from and the dimensions it is joined to.
STARS = {
    "fact_arrivals": (facts.fact_arrivals, "arrivals", ("dim_time", "dim_line", "dim_station")),
    "fact_line_status": (facts.fact_line_status, "line_status", ("dim_time", "dim_line", "dim_disruption")),
}

# Keys of each fact: dimension, surrogate key, the fact's and the dimension's name of the member.
MEMBER_KEYS = {
    "fact_arrivals": (("dim_line", "line_key", "line_id", "line_id"), ("dim_station", "station_key", "naptan_id", "naptan_id")),
    "fact_line_status": (
        ("dim_line", "line_key", "line_id", "line_id"), ("dim_disruption", "disruption_key", "status_severity", "severity_code"),
    ),
}


def refresh_dimension(
    spark: SparkSession, name: str, paths: Mapping[str, str], holidays: DataFrame | None = None, at: str | None = None
) -> None:
    """Rebuild one dimension; members it held before keep their keys."""
    if name == "dim_time":
        write_dimension(dims.dim_time(spark, at), paths[name])
    elif name == "dim_date":
        span = filed_days(spark, *(paths[source] for _, source, _ in STARS.values()))
        if span is not None:
            write_dimension(dims.dim_date(spark, *span, holidays, at), paths[name])
    else:
        build, sources = MEMBERS[name]
        previous = read_table_if_any(spark, paths[name])
        with scratch_scope(spark):
            write_dimension(build(*(cleaned(spark, s, paths) for s in sources), previous, at=at), paths[name])


def refresh_fact(
    spark: SparkSession, name: str, paths: Mapping[str, str], at: str | None = None,
    first: date | None = None, last: date | None = None, folders: Collection[str] | None = None,
) -> None:
    """Rebuild a fact, or only the given days or folders of it."""
    build, source, dimensions = STARS[name]
    joined = [read_table(spark, paths[d]) for d in dimensions]
    rows = cleaned(spark, source, paths, first=first, last=last)
    if folders is not None:
        rows = rows.where(in_folders(PARTITION_COLUMNS, folders))
    # Cleaned rows are filed by the fact's own day, and broadcast joins leave them in place.
    write_partitioned(
        build(rows, *joined, at), paths[name], filed=all(map(fits_broadcast, joined)),
        only_touched=first is not None or last is not None or folders is not None, emptied=folders or (),
    )


def refresh_new(
    spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str,
    holidays: DataFrame | None = None, at: str | None = None,
) -> dict[str, set[str]]:
    """Bring every table up to what has landed since the last run, and name the folders that changed.

    The result is that of ``refresh``, but for the surrogate keys of members that
    a rebuild would number anew.  A dimension is built again only if a table it is
    made from has changed.  A fact is built again in the folders that changed, and
    in those whose rows had to do without a member that is known by now.
    """
    paths = table_paths(silver_root, gold_root)
    changed = {feed: take_in(spark, feed, f"{bronze_root}/{feed}", paths[feed], at) for feed in silver.TABLES}
    for name in DIMENSIONS:
        sources = MEMBERS[name][1] if name in MEMBERS else [source for _, source, _ in STARS.values()]
        if any(changed[s] for s in sources) or read_table_if_any(spark, paths[name]) is None:
            refresh_dimension(spark, name, paths, holidays, at)
    for name in FACTS:
        source = STARS[name][1]
        folders = changed[source] | late_members(spark, name, paths)
        if read_table_if_any(spark, paths[name]) is None:
            refresh_fact(spark, name, paths, at)
        elif folders:
            refresh_fact(spark, name, paths, at, folders=folders)
        changed[name] = folders
    return changed


def late_members(spark: SparkSession, name: str, paths: Mapping[str, str]) -> set[str]:
    """Folders of a fact with rows that lack the key of a member which its dimension has by now.

    Parquet's null counts spare the scan what has all its keys.
    """
    fact = read_table_if_any(spark, paths[name])
    found: set[str] = set()
    for dimension, key, own, member in () if fact is None else MEMBER_KEYS[name]:
        known = read_table(spark, paths[dimension]).select(F.col(member).alias("_known"))
        lacking = fact.where(F.col(key).isNull() & F.col(own).isNotNull())
        found |= folders_of(lacking.join(known, F.col(own) == F.col("_known"), "left_semi"), PARTITION_COLUMNS)
    return found


def refresh(
    spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str,
    holidays: DataFrame | None = None, at: str | None = None,
) -> dict[str, str]:
    """Build every table in dependency order and return the path of each."""
    paths = table_paths(silver_root, gold_root)
    for feed in silver.TABLES:
        refresh_silver(spark, feed, f"{bronze_root}/{feed}", paths[feed], at)
    for name in DIMENSIONS:
        refresh_dimension(spark, name, paths, holidays, at)
    for name in FACTS:
        refresh_fact(spark, name, paths, at)
    return paths


def backfill(
    spark: SparkSession, feed: str, bronze: str, path: str, first: date, last: date,
    last_landed: date | None = None, at: str | None = None,
) -> None:
    """Replace the cleaned rows of ``[first, last]`` by what the raw layer now gives for them.

    Rows land on or after the day they belong to (a day of clock difference is
    allowed for), so raw folders before ``first`` are not read.  A row may land
    any time later, so there is no upper limit unless the caller can vouch for
    ``last_landed``.  Days left without rows become empty.  A key of the range
    whose newest reading belongs to another day moves there; other rows of other
    days stay.  Running it again changes nothing.

    Days that the table holds but whose raw folders are gone cannot be redone:
    that is an error, and nothing is changed.
    """
    table = silver.TABLES[feed]
    landed = [date(*d) for d in folder_values(spark, bronze, DAY_FOLDERS)]
    held = [d for d in (date(*d) for d in folder_values(spark, path, PARTITION_COLUMNS)) if first <= d <= last]
    expired = [d for d in held if not landed or d < min(landed) - timedelta(days=1)]
    if expired:
        raise ValueError(f"raw data of {expired[0]} has gone, so that day cannot be redone")

    in_range = in_days(PARTITION_COLUMNS, first, last)
    with scratch_scope(spark):
        raw = read_feed(spark, bronze, feed_schema(feed), first - timedelta(days=1), last_landed)
        rows = silver.build(table, raw, at)
        if not table.filed_by_key:
            rows = materialise(rows, "backfill")
            # Readings of the range's keys that belong to other days count as well.
            existing = read_table_if_any(spark, path)
            concerned = silver.with_days(table, raw).where(in_range).select(*table.keys)
            if existing is not None:
                concerned = concerned.unionByName(existing.where(in_range).select(*table.keys))
            concerned = materialise(concerned.distinct(), "concerned")
            rows = rows.alias("r").join(concerned.alias("c"), same("r", "c", table.keys), "left_semi")
        else:
            # The merge writes them out itself, in the places where they were deduplicated.
            rows = rows.where(in_range)
        upsert_table(path, rows, table.keys, table.newest or table.keys, filed_by_key=table.filed_by_key, outdated=in_range)
