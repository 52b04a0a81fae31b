"""Secrets in texts, and how widely each is copied.

Candidates are assignments, access keys and long hexadecimal runs (the base
kinds), and other long tokens that mix cases and digits.  Each candidate's value
is hashed and counted over the whole corpus by the distinct repositories and
owners it occurs in.  A value of many owners is a copied example; one of few
owners looks live.  Base spans always stay; a mixed token is added only if it
looks live.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.session import materialise

#: The base kinds in their order, and what each must match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8

#: The kind that the method adds.
MIXED = r"[A-Za-z0-9+/_-]{24,}"
KINDS = ("assign", "access", "hex", "mixed")
BASE = 3

#: A value with this many owners or more is a copied example, and so is one of two
#: owners in this many repositories.  However many repositories one owner has it in,
#: it is that owner's own.
COPIED_OWNERS = 3
COPIED_REPOSITORIES = 5

MASK = "[SECRET]"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value made once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _sums_before(lengths: Column) -> Column:
    """The sum of the lengths before each, in pieces of about the root of their number.

    Appending to an array in a fold would copy it at every step.
    """
    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def placed(size: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.ceil(F.size(lengths) / size).cast("int")), lambda j: F.slice(lengths, j * size + 1, size))
        sums = F.transform(pieces, total)
        before = _let(sums, lambda s: F.transform(s, lambda _, j: total(F.slice(s, 1, j))))
        inner = F.transform(pieces, lambda p: F.transform(p, lambda _, k: total(F.slice(p, 1, k))))
        return F.flatten(F.zip_with(inner, before, lambda p, b: F.transform(p, lambda x: x + b)))

    return _let(F.greatest(F.ceil(F.sqrt(F.size(lengths))).cast("int"), F.lit(1)), placed)


def _spans(text: Column, pattern: str, value: int) -> Column:
    """Leftmost non-overlapping matches as structs (from, to, value), in code points.

    Splitting gives what lies between the matches; with the matches' own lengths
    that gives their places.
    """
    def placed(found: Column) -> Column:
        between = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
        own = F.transform(found, lambda m: F.length(m))
        # Gap and match by turns; what lies before a match ends with its gap.
        steps = _let(F.zip_with(F.slice(between, 1, F.size(found)), own, lambda g, m: F.struct(g.alias("gap"), m.alias("own"))), lambda z: F.zip_with(
            z, _let(F.transform(z, lambda x: x["gap"] + x["own"]), _sums_before),
            lambda x, b: F.struct((b + x["gap"]).alias("start"), (b + x["gap"] + x["own"]).alias("stop")),
        ))
        return F.zip_with(steps, found, lambda s, m: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), (F.regexp_extract(m, pattern, value) if value else m).alias("value"),
        ))

    empty = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(empty)


def _kind(spans: Column, order: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("kind"), s["stop"].alias("stop"), s["value"].alias("value")
    ))


def find_spans(text: Column) -> Column:
    """All base spans of a text and all mixed tokens: array of (start, kind, stop, value)."""
    assign = F.filter(_spans(text, ASSIGN, 1), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    mixed = F.filter(
        _spans(text, MIXED, 0),
        lambda s: s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]") & s["value"].rlike("[0-9]"),
    )
    return F.concat(_kind(assign, 0), _kind(_spans(text, ACCESS, 0), 1), _kind(_spans(text, HEX, 0), 2), _kind(mixed, BASE))


def clear_of_base(spans: DataFrame, text: Sequence[str]) -> DataFrame:
    """All base spans, and the mixed tokens that none of the same text (columns ``text``) overlaps."""
    is_base = F.col("kind") < BASE
    # Both run from one end on: a frame up to the other end would be gone through for every row.
    up_to, from_here = (
        Window.partitionBy(*text).orderBy(order).rangeBetween(Window.unboundedPreceding, 0) for order in (F.asc("start"), F.desc("start"))
    )
    reaches = F.coalesce(F.max(F.when(is_base, F.col("stop"))).over(up_to) > F.col("start"), F.lit(False))
    begins = F.coalesce(F.min(F.when(is_base, F.col("start"))).over(from_here) < F.col("stop"), F.lit(False))
    return spans.withColumn("_hit", ~is_base & (reaches | begins)).where("not _hit").drop("_hit")


def ownership(spans: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each value hash (columns hash, owner, repository)."""
    # Copies within a repository fold in the first step, before anything is shuffled by hash alone.
    seen = spans.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = seen.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("occurrences")
    )


def copied() -> Column:
    """Whether a value with these ``owners`` and ``repositories`` is an example: many have it, or two in many places."""
    owners, repositories = F.col("owners"), F.col("repositories")
    return (owners >= COPIED_OWNERS) | ((owners > 1) & (repositories >= COPIED_REPOSITORIES))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: Sequence[str] = ("source", "lang")
) -> DataFrame:
    """Rows (key, version, spans) for each document with a span; ``version`` is the text's hash.

    ``spans`` is a sorted array of (start, kind, stop, owners, live): offsets are
    code points, the end exclusive, and kind is an index into ``KINDS``.  A base
    span is live unless its value is ``copied``; a mixed
    token that is not live is left out.  Null texts count as empty; null owners
    are one owner; repeated rows give one row.
    """
    named = docs.select(
        docs[f"`{key}`"].alias("_key"), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("_body"),
        F.coalesce(docs[f"`{owner}`"], F.lit("")).alias("owner"),
        F.concat_ws("/", *(F.coalesce(docs[f"`{c}`"], F.lit("")) for c in repository)).alias("repository"),
    )
    found = named.select("_key", F.xxhash64("_body").alias("version"), "owner", "repository", find_spans(F.col("_body")).alias("_s"))
    flat = found.where(F.size("_s") > 0).select("_key", "version", "owner", "repository", F.inline("_s"))
    flat = clear_of_base(flat, ["_key", "version"]).withColumn("hash", F.sha2("value", 256)).drop("value")
    flat = materialise(flat, "spans")
    spread = materialise(ownership(flat), "ownership")
    judged = flat.join(spread.select("hash", "owners", "repositories"), "hash").withColumn("live", ~copied())
    stays = judged.where((F.col("kind") < BASE) | F.col("live"))
    span = F.struct("start", "kind", "stop", "owners", "live")
    return stays.groupBy(F.col("_key").alias(key), "version").agg(F.sort_array(F.collect_set(span)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    ), ",")


def _of_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", **columns) -> DataFrame:
    """One row for every row of ``docs``: counts by base kind, all spans, and how many look live."""
    found = scan(docs, key, text, **columns).withColumnRenamed(key, "_key")
    ids = docs.select(docs[f"`{key}`"].alias(key), F.xxhash64(F.coalesce(docs[f"`{text}`"], F.lit(""))).alias("_version"))
    same = ids[key].eqNullSafe(found["_key"]) & (ids["_version"] == found["version"])
    none = F.array().cast(found.schema["spans"].dataType)
    joined = ids.join(found, same, "left").select(key, F.coalesce("spans", none).alias("_spans"))
    base = F.filter("_spans", lambda s: s["kind"] < BASE)
    counts = [F.size(_of_kind(F.col("_spans"), k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return joined.select(
        key, *counts, F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("_spans")).alias("spans"),
        F.size(F.filter("_spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by a mask; overlapping spans by one."""
    step = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK)),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text) - acc["at"])),
    )
    return F.when(F.size(spans) > 0, step).otherwise(text)
