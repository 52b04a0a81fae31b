"""Quality rules whose thresholds follow the corpus: fences from mergeable quantile sketches.

Every measure of a document is a whole number.  A sketch is a count for each
bucket of a measure, buckets being exact below 64 and 1/32 wide above, so a
quantile is off by about three percent at most.  Sketches merge by adding counts:
those of a language are the sum of its sources', those of all the sum of the
languages'.  A group with too few rows uses the sketch above it.

A document is an outlier if a measure lies beyond its group's fence, which comes
from the sketch of the group's documents that pass the fixed rule:

* lengths of words: the upper or lower quartile plus or minus ``REACH`` times the
  distance between them;
* measures that most documents have none of: the same with ``REACH_SOME``, from the
  quartiles of the documents that have some;
* of these, one that ordinary documents lack altogether (``rare``): where at most one
  in ``RARE`` documents of the group has any, half the lower quartile of those that do,
  however few, but ``LEAST_RARE`` at least.

Only if all documents together have too few values is a fixed fence used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.llm.words import SPACE_CLASS, window_hashes, words
from siltstone.session import materialise

SYMBOLS = "[#*$%&|<>]"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: Distances between the quartiles that a fence lies beyond them.
REACH = 5
REACH_SOME = 3
#: What one in so many documents has at most is rare in a group.
RARE = 10
LEAST_RARE = 20
#: Groups with fewer rows, or fewer values that count, borrow the sketch of their language, or of all.
LEAST_ROWS = 200
LEAST_VALUES = 20


@dataclass(frozen=True)
class Measure:
    """A whole number for each document.

    ``some``: only values above zero shape the fence.  ``fixed`` is the fence
    where all documents have too few values; without one there is no fence then.
    ``least_spread`` is the distance of equal quartiles.
    """

    name: str
    value: str
    least_spread: int
    upper: bool = True
    some: bool = False
    rare: bool = False
    fixed: int | None = None


MEASURES = (
    Measure("symbols", "1000 * n_symbols div greatest(word_chars, 1)", 10, some=True, rare=True, fixed=80),
    Measure("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 10, some=True, fixed=400),
    Measure("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 10, some=True, fixed=300),
    Measure("long_words", "100 * word_chars div greatest(n_words, 1)", 20),
    Measure("short_words", "100 * word_chars div greatest(n_words, 1)", 20, upper=False),
)


def base_measures(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep`` and the counts of each row's whole text; other columns are not read.

    Null, empty and blank texts count nothing.  Rows are measured one by one, so
    repeated rows come out as often as they went in.
    """
    kept = [F.col(f"_k{i}") for i in range(len(keep))]
    start = docs.select(
        *(docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("_t")
    )
    cut = start.select(
        *kept, "_t", words(F.col("_t")).alias("_w"),
        F.filter(F.split("_t", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
    )
    hashed = cut.select(
        *kept,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS + "+", ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        window_hashes(F.col("_w"), REPEAT_WINDOW).alias("_h"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # Sorting finds equal hashes; only a document that has some is sorted.
    sorted_ = hashed.select(
        *kept, *counts,
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.lit(None)).alias("_s"),
    )
    twice = F.filter("_s", lambda x, k: x["h"].eqNullSafe(F.get("_s", k - 1)["h"]) | x["h"].eqNullSafe(F.get("_s", k + 1)["h"]))
    placed = sorted_.select(*kept, *counts, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_at"))
    gaps = F.transform(
        "_at", lambda p, k: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get("_at", k + 1) - p, F.lit(REPEAT_WINDOW)))
    )
    covered = F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return placed.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), *counts, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    """The fixed rule: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def bucket(value: Column) -> Column:
    """The sketch's bucket of a whole number of 0 or more; buckets keep the order of values."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return shift * 32 + F.call_function("shiftright", value, shift).cast("int")


def bucket_edge(number: Column, upper: bool) -> Column:
    """The greatest or least value that falls into a bucket."""
    shift = F.greatest(F.floor(number / 32) - 1, F.lit(0)).cast("int")
    head = number - shift * 32
    low = F.call_function("shiftleft", head.cast("long"), shift)
    return F.call_function("shiftleft", (head + 1).cast("long"), shift) - 1 if upper else low


def sketches(measured: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Counts by group, measure and bucket; merging is a sum by fewer groups."""
    values = F.array(*(F.struct(F.lit(m.name).alias("measure"), bucket(F.expr(m.value)).alias("bucket")) for m in MEASURES))
    return measured.select(*groups, F.inline(values)).groupBy(*groups, "measure", "bucket").agg(F.count("*").alias("n"))


def _by_measure(value) -> Column:
    """The column that ``value`` gives for each measure."""
    made = F.lit(None)
    for m in MEASURES:
        made = F.when(F.col("measure") == m.name, value(m)).otherwise(made)
    return made


def _fence(m: Measure, low: Column, high: Column) -> Column:
    """The fence from a sketch's quartiles, null if too few of its rows have values."""
    reach = (REACH_SOME if m.some else REACH) * F.greatest(high - low, F.lit(m.least_spread))
    fence = (high + reach if m.upper else low - reach).cast("long")
    enough = F.col("values") >= LEAST_VALUES
    if m.rare:
        few = (F.col("values") > 0) & (RARE * F.col("values") <= F.col("rows"))
        return F.when(few, F.greatest(F.expr("_low div 2"), F.lit(LEAST_RARE))).when(enough, fence)
    return F.when(enough, fence)


def _fences(sketch: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Each group's and measure's fence, null where the sketch has too few values; and its numbers of rows and values."""
    keys = [*groups, "measure"]
    counted = F.when((F.col("bucket") > 0) | ~_by_measure(lambda m: F.lit(m.some)), F.col("n")).otherwise(F.lit(0))
    merged = sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n")).withColumn("_w", counted)
    of_group = Window.partitionBy(*keys)
    ranked = merged.select(
        *keys, "bucket", "_w", F.sum("_w").over(of_group.orderBy("bucket")).alias("_below"),
        F.sum("_w").over(of_group).alias("_values"), F.sum("n").over(of_group).alias("_rows"),
    )
    has = F.col("_w") > 0
    quarters = ranked.groupBy(*keys).agg(
        F.max("_rows").alias("rows"), F.max("_values").alias("values"),
        F.min(F.when(has & (4 * F.col("_below") >= F.col("_values")), F.col("bucket"))).alias("_q1"),
        F.min(F.when(has & (4 * F.col("_below") >= 3 * F.col("_values")), F.col("bucket"))).alias("_q3"),
    ).withColumns({"_low": bucket_edge(F.col("_q1"), False), "_high": bucket_edge(F.col("_q3"), True)})
    fence = _by_measure(lambda m: _fence(m, F.col("_low"), F.col("_high")))
    return quarters.select(*keys, "rows", "values", fence.alias("fence"))


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row for each (lang, source) with the fence of every measure, and how many of these are the group's own."""
    own = materialise(sketches(measured.where(~base_failed()), [lang, source]), "sketches")
    enough = F.col("rows") >= LEAST_ROWS
    by_source = _fences(own, [lang, source]).where(enough).select(lang, source, "measure", F.col("fence").alias("_own"))
    by_lang = _fences(own, [lang]).where(enough).select(lang, "measure", F.col("fence").alias("_lang"))
    overall = _fences(own, []).select("measure", F.col("fence").alias("_all"))
    groups = measured.select(lang, source).distinct().withColumn("measure", F.explode(F.lit([m.name for m in MEASURES])))
    chosen = groups.join(by_source, [lang, source, "measure"], "left").join(by_lang, [lang, "measure"], "left").join(
        F.broadcast(overall), "measure", "left"
    )
    fixed = _by_measure(lambda m: F.lit(m.fixed).cast("long"))
    best = F.coalesce("_own", "_lang", "_all", fixed)
    return chosen.select(lang, source, "measure", best.alias("fence"), F.col("_own").isNotNull().alias("_is_own")).groupBy(lang, source).agg(
        *(F.max(F.when(F.col("measure") == m.name, F.col("fence"))).alias(f"fence_{m.name}") for m in MEASURES),
        F.count_if("_is_own").alias("own_fences"),
    )


def judge(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """Columns ``keep``, the counts, ``base_failed``, ``outlier`` and ``kept`` for every row of ``docs``.

    A missing language or source is a group of its own (with the empty name).
    Documents that fail the fixed rule shape no fence.  Texts and other columns do
    not travel: only counts are shuffled.
    """
    groups = [F.coalesce(docs[f"`{c}`"], F.lit("")).alias(a) for c, a in ((lang, "_lang_of"), (source, "_source_of"))]
    named = docs.select(*(docs[f"`{c}`"].alias(f"_p{i}") for i, c in enumerate(keep)), *groups, docs[f"`{text}`"].alias("_body"))
    ids = [f"_p{i}" for i in range(len(keep))]
    measured = materialise(base_measures(named, [*ids, "_lang_of", "_source_of"], "_body"), "measured")
    fences = materialise(thresholds(measured, "_lang_of", "_source_of"), "thresholds")
    beyond = F.lit(False)
    for m in MEASURES:
        value, fence = F.expr(m.value), F.col(f"fence_{m.name}")
        beyond = beyond | F.coalesce(value > fence if m.upper else value < fence, F.lit(False))
    judged = measured.join(fences, ["_lang_of", "_source_of"]).withColumns({"base_failed": base_failed(), "outlier": beyond})
    return judged.select(
        *(F.col(i).alias(c) for i, c in zip(ids, keep)), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "outlier", (~F.col("base_failed") & ~F.col("outlier")).alias("kept"),
    )
