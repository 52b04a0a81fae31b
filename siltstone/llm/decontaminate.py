"""Benchmark items inside long documents, by size-partitioned MinHash sketches.

The question is containment: which share of an item's shingles occurs in a
document.  Items are partitioned by their number of shingles, doubling from one
partition to the next.  A sketch is an item's ``k`` least shingle hashes.  For a
partition with at most ``u`` shingles and a threshold ``t``, a document that
holds ``t`` of an item misses ``u - ceil(t u)`` shingles at most, so with
``k = u - ceil(t u) + 1`` it must hold one of the sketch.  The long side is not
sketched: every shingle hash of a document probes the sketches, since a sketch
of a document a hundred times longer than the item would hardly ever hold one of
its shingles.  So no item is missed; candidates are verified by exact containment.

An item of fewer words than a shingle is one shingle, of its own length.  Documents
are then probed with their windows of that length as well, of which there are as many
lengths as shingles have words less one, at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.llm.words import shingle_hashes, shingles, window_hashes, words
from siltstone.session import materialise

SHINGLE_WORDS = 5
LEAST_CONTAINMENT = 0.8

#: Sketch rows that are broadcast at most (16 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 500_000


def normal_words(text: Column) -> Column:
    """Words in lower case."""
    return words(F.lower(text))


def sketch_size(shingle_count: Column, threshold: float) -> Column:
    """How many least hashes the partition of this many shingles keeps."""
    upper = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(shingle_count))) - 1
    return (upper - F.ceil(upper * F.lit(threshold)) + 1).cast("int")


def item_shingles(items: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """(item, _shingles, _hashes) of each item that has words; repeated rows are one."""
    cut = items.select(F.col(f"`{item}`").alias("_item"), normal_words(F.col(f"`{text}`")).alias("_w")).where(F.size("_w") > 0)
    held = cut.select("_item", shingles(F.col("_w"), size).alias("_shingles"), shingle_hashes(F.col("_w"), size).alias("_hashes"))
    return held.distinct()


def sketches(cut: DataFrame, threshold: float) -> DataFrame:
    """Rows (_hash, _item): the sketch of every item, in partitions by size."""
    count = sketch_size(F.size("_hashes").cast("long"), threshold)
    least = F.slice(F.sort_array("_hashes"), 1, F.greatest(count, F.lit(1)))
    return cut.select("_item", F.explode(least).alias("_hash")).distinct()


def short_lengths(items: DataFrame, size: int) -> list[int]:
    """In how many words items are shorter than a shingle; fewer than ``size`` numbers."""
    lengths = items.select(F.size(F.split(F.get("_shingles", 0), " ")).alias("n")).where(F.col("n") < size).distinct()
    return sorted(r["n"] for r in lengths.collect())


def probe_hashes(found: Column, size: int, lengths: list[int]) -> Column:
    """The hashes that a document may share with items."""
    made = [shingle_hashes(found, size), *(window_hashes(found, n) for n in lengths)]
    return F.array_distinct(F.concat(*made)) if lengths else made[0]


def probe_shingles(found: Column, size: int, lengths: list[int]) -> Column:
    """The shingles that a document may share with items."""
    none = F.array().cast("array<string>")
    made = [shingles(found, size), *(F.when(F.size(found) >= n, shingles(found, n)).otherwise(none) for n in lengths)]
    return F.concat(*made) if lengths else made[0]


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", size: int = SHINGLE_WORDS, threshold: float = LEAST_CONTAINMENT,
) -> DataFrame:
    """Rows (key, item, n_shingles, n_shared, containment) where a document holds ``threshold`` of an item.

    Words are compared in lower case.  An item of fewer than ``size`` words is one
    shingle, found wherever its words stand in this order.
    Null, empty and blank texts match nothing; rows with a null key or item are
    reported like others; repeated rows give one row; copies of an item are each
    reported; empty tables give no rows; other columns are not read.
    """
    cut = materialise(item_shingles(items, item, item_text, size), "items")
    sketch = materialise(sketches(cut, threshold), "sketch")
    lengths = short_lengths(cut, size)
    if sketch.count() <= BROADCAST_ROWS:
        sketch = F.broadcast(sketch)

    named = docs.select(docs[f"`{key}`"].alias("_key"), docs[f"`{text}`"].alias("_body"))
    named = named.withColumn("_version", F.xxhash64("_body"))
    cut_words = named.select("_key", "_version", normal_words(F.col("_body")).alias("_w"))
    probes = cut_words.select("_key", "_version", F.explode(probe_hashes(F.col("_w"), size, lengths)).alias("_hash"))
    candidates = materialise(probes.join(sketch, "_hash").select("_key", "_version", "_item").distinct(), "candidates")

    # Only documents with a candidate have their texts cut again.
    hit = candidates.select("_key", "_version").distinct()
    found = named.alias("d").join(
        hit.alias("h"), F.col("d._version").eqNullSafe(F.col("h._version")) & F.col("d._key").eqNullSafe(F.col("h._key")), "left_semi"
    ).distinct().select("_key", "_version", normal_words(F.col("_body")).alias("_w"))
    found = found.select("_key", "_version", probe_shingles(F.col("_w"), size, lengths).alias("_held"))
    pairs = candidates.alias("c").join(
        found.alias("f"), F.col("c._version").eqNullSafe(F.col("f._version")) & F.col("c._key").eqNullSafe(F.col("f._key"))
    ).select("c._key", "c._item", "f._held")
    pairs = pairs.alias("p").join(cut.alias("i"), F.col("p._item").eqNullSafe(F.col("i._item")))
    shared = F.size(F.array_intersect("i._shingles", "p._held")).cast("long")
    measured = pairs.select(
        F.col("p._key").alias(key), F.col("p._item").alias(item), F.size("i._shingles").cast("long").alias("n_shingles"),
        shared.alias("n_shared"),
    ).withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    return measured.where(F.col("containment") >= threshold).distinct()
