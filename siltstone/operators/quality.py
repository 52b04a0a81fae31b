"""Quality checks as rows, and a health report over many tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltstone.functions.cleaning import as_timestamp
from siltstone.operators.records import union_batches


#: Address bits of the key sketches: 1.04 / sqrt(2 ** bits) is their standard error.
HLL_BITS = 12


@dataclass(frozen=True)
class Expectations:
    """What a table should satisfy; ``schema`` is compared by column name and type."""

    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    schema: T.StructType | None = None


def schema_differences(actual: T.StructType, expected: T.StructType) -> dict[str, bool]:
    """Whether each expected or surplus column differs."""
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in expected.fields}
    return {name: have.get(name) != want.get(name) for name in {**want, **have}}


def _result(check: str, column: str, failed: Column, total: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(column).alias("column"),
        failed.cast("long").alias("failed"), total.alias("total"), (failed == 0).alias("passed"),
    )


def _failures(expect: Expectations) -> dict[tuple[str, str], Column]:
    return {
        **{("not_null", c): F.col(c).isNull() for c in expect.required},
        **{("timestamp", c): F.col(c).isNotNull() & as_timestamp(c).isNull() for c in expect.timestamps},
    }


def _column_checks(df: DataFrame, expect: Expectations, *extra: Column) -> tuple[DataFrame, list[Column]]:
    """One aggregate over the table, and the result structs to be read from its row."""
    failures = _failures(expect)
    counted = [F.count_if(bad).alias(f"_{i}") for i, bad in enumerate(failures.values())]
    totals = df.agg(F.count(F.lit(1)).alias("_total"), *counted, *extra)
    results = [_result(*name, F.col(f"_{i}"), F.col("_total")) for i, name in enumerate(failures)]
    if expect.schema is not None:
        differs = schema_differences(df.schema, expect.schema)
        results += [_result("schema", c, F.lit(int(bad)), F.col("_total")) for c, bad in differs.items()]
    return totals, results


def _unique_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat a key.  Counts are combined before they are shuffled."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeats = per_key.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_repeats"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_total")
    )
    row = _result("unique", ",".join(keys), F.col("_repeats"), F.col("_total"))
    return repeats.select(row.alias("_r")).select("_r.*")


def quality_report(df: DataFrame, expect: Expectations) -> DataFrame:
    """Rows ``(check, column, failed, total, passed)``.

    All column checks come from one aggregate over the table; uniqueness needs
    a second one by key.
    """
    totals, results = _column_checks(df, expect)
    reports = [totals.select(F.explode(F.array(*results)).alias("_r")).select("_r.*")] if results else []
    if expect.unique:
        reports.append(_unique_check(df, expect.unique))
    if not reports:
        raise ValueError("nothing to check")
    return union_batches(reports)


def health_report(tables: Mapping[str, tuple[DataFrame, str | None, Expectations]]) -> DataFrame:
    """Per table: rows, newest ingest time and share of checks passed."""
    parts = []
    for name, (df, ingested, expect) in tables.items():
        newest = F.max(F.col(ingested)).cast("timestamp") if ingested else F.lit(None).cast("timestamp")
        totals, results = _column_checks(df, expect, newest.alias("_newest"))
        verdicts = [r.getField("passed") for r in results]
        if expect.unique:
            verdicts.append(_unique_check(df, expect.unique).select("passed").scalar())
        if not verdicts:
            raise ValueError(f"nothing to check in {name}")
        passed = reduce(lambda a, b: a + b, [v.cast("int") for v in verdicts])
        parts.append(totals.select(
            F.lit(name).alias("table"), F.col("_total").alias("rows"), F.col("_newest").alias("newest"),
            (passed / len(verdicts)).alias("pass_rate"),
        ))
    return union_batches(parts)


def profile(df: DataFrame, expect: Expectations, folders: Sequence[str], ingested: str | None = None) -> DataFrame:
    """Per folder what the checks add up, for ``states.keep_states``.

    Rows, failures by column, the newest ingest time, repeats of a key within the
    folder, and a sketch of its keys (HyperLogLog, 1.6 % standard error).
    """
    measures = [
        F.count(F.lit(1)).alias("rows"), *(F.count_if(bad).alias(":".join(name)) for name, bad in _failures(expect).items()),
        (F.max(ingested).cast("timestamp") if ingested else F.lit(None).cast("timestamp")).alias("newest"),
    ]
    if not expect.unique:
        return df.groupBy(*folders).agg(*measures)
    hashed = F.xxhash64(*expect.unique)
    profiles = df.groupBy(*folders).agg(*measures, F.hll_sketch_agg(hashed, F.lit(HLL_BITS)).alias("keys"))
    # Counted by key and then added up, so that no task holds a folder's keys.
    per_key = df.groupBy(*folders, *expect.unique).agg((F.count(F.lit(1)) - 1).alias("_n"))
    repeats = per_key.groupBy(*folders).agg(F.sum("_n").alias("repeats"))
    other = repeats.select("repeats", *(F.col(c).alias(f"_r{i}") for i, c in enumerate(folders)))
    on = [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(folders)]
    return profiles.join(other, on).drop(*(f"_r{i}" for i in range(len(folders))))


def _counts(expect: Expectations) -> list[tuple[str, str, str]]:
    """(check, column, name in a profile) of all that profiles count."""
    counts = [(check, column, f"{check}:{column}") for check, column in _failures(expect)]
    return counts + ([("unique", ",".join(expect.unique), "repeats")] if expect.unique else [])


def merged_profile(profiles: DataFrame, expect: Expectations) -> DataFrame:
    """One row: the profile of all folders together.

    All but ``distinct_keys`` is exact; ``repeats`` are those within folders, which
    are all there are when a key fixes its folder.
    """
    added = ["rows", *(name for _, _, name in _counts(expect))]
    merged = [F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in added]
    if expect.unique:
        merged.append(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("keys")), F.lit(0)).alias("distinct_keys"))
    return profiles.agg(*merged, F.max("newest").alias("newest"))


def quality_of_profiles(profiles: DataFrame, expect: Expectations) -> DataFrame:
    """``quality_report`` from the profiles of folders that keys fix; the table is not read."""
    results = [_result(check, column, F.col(f"`{name}`"), F.col("rows")) for check, column, name in _counts(expect)]
    if not results:
        raise ValueError("nothing to check")
    return merged_profile(profiles, expect).select(F.explode(F.array(*results)).alias("_r")).select("_r.*")


def health_of_profiles(tables: Mapping[str, tuple[DataFrame, Expectations]]) -> DataFrame:
    """``health_report`` from the profiles of each table's folders."""
    parts = []
    for name, (profiles, expect) in tables.items():
        failed = [f"`{count}`" for _, _, count in _counts(expect)]
        if not failed:
            raise ValueError(f"nothing to check in {name}")
        passed = reduce(lambda a, b: a + b, [(F.col(c) == 0).cast("int") for c in failed])
        parts.append(merged_profile(profiles, expect).select(
            F.lit(name).alias("table"), "rows", "newest", (passed / len(failed)).alias("pass_rate")
        ))
    return union_batches(parts)
