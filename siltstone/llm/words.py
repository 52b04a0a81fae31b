"""Words and word shingles as built-in expressions.

What takes ``found`` must be given a column that holds words, not the expression
that makes them: inside a lambda that would be made again for every window.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: ASCII white space: space, and the controls 9 to 13.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """What lies between runs of ASCII white space; none for null, empty or blank text."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def _starts(found: Column, size: int) -> Column:
    """Where windows of ``size`` words begin, counted from 0; a shorter text has one window."""
    return F.sequence(F.lit(0), F.greatest(F.size(found) - size, F.lit(0)))


def window_hashes(found: Column, size: int) -> Column:
    """A 64-bit hash of each window of ``size`` words; none if there are fewer words."""
    full = F.transform(_starts(found, size), lambda i: F.xxhash64(*(F.get(found, i + k) for k in range(size))))
    return F.when(F.size(found) >= size, full).otherwise(F.array().cast("array<bigint>"))


def shingles(found: Column, size: int) -> Column:
    """Distinct windows of ``size`` words, space-joined; fewer words make one, none make none."""
    joined = F.transform(_starts(found, size), lambda i: F.array_join(F.slice(found, i + 1, size), " "))
    return F.when(F.size(found) > 0, F.array_distinct(joined)).otherwise(F.array().cast("array<string>"))


def shingle_hashes(found: Column, size: int) -> Column:
    """The distinct hashes of what ``shingles`` gives, without building the strings.

    A shingle of fewer than ``size`` words has the hash of its words alone.
    """
    return F.array_distinct(F.when(F.size(found) > 0, F.transform(
        _starts(found, size), lambda i: F.xxhash64(*(F.get(found, i + k) for k in range(size)))
    )).otherwise(F.array().cast("array<bigint>")))
