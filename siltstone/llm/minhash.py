"""Near-duplicates by the words they share: one-permutation MinHash, exact Jaccard of word shingles decides.

A text's set holds the hashes of its windows of five words, A-Z in lower case; a
shorter text is one window.  One hash function serves all of the signature: the
first bits of a shingle's hash say which of ``BINS`` bins it falls into, and a bin's
value is the least hash in it.  An empty bin takes the value of a full one, the
first that is full in a random order of bins which is the empty bin's own (optimal
densification), so that each bin's values of two texts are equal with a chance of
their similarity, for short texts as well.

``rows`` bins joined make a band's key.  How many is derived from the similarity
asked for: as many as leave a pair of just that similarity without a common key
with a chance of ``MISS`` at most (with 512 bins: 9 rows and 56 bands for 0.85).

Candidates of a bucket are a star: each member with the bucket's hub, the member
that lies in the largest buckets, which copies of one text mostly link to.  What
the stars join is one group; only then members of different groups that share a
bucket meet, and only if neither a bound on what they share, from the places their
hashes fall on, nor a bit for each bin rules a link out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltstone.llm.arrow import with_texts
from siltstone.llm.components import components
from siltstone.session import materialise

SEED = 42
SHINGLE_WORDS = 5
#: Least similarity of a link, as a fraction of whole numbers.
SIMILAR = (85, 100)
#: The chance to leave a pair of the least similarity without a common key.
MISS = 1e-5
BINS = 512
#: Standard deviations by which the bits of a pair may lie off what the least similarity expects.
DEVIATIONS = 6

#: Rows of a side table that are broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000

_SHIFT = np.uint64(64 - 9)
_WORDS = BINS // 64
#: Places that a set's hashes are marked on, to bound what two sets share.
PLACES = 1_024


def band_rows(similar: tuple[int, int] = SIMILAR) -> int:
    """Bins in a band: the most that keep the chance of a miss within ``MISS``."""
    s = similar[0] / similar[1]
    fits = [r for r in range(1, 65) if (1 - s**r) ** (BINS // r) <= MISS]
    if not fits or s > 1:
        raise ValueError(f"no bands of {BINS} bins find links of similarity {s}")
    return max(fits)


def shingle_set(text: bytes | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order; none without words."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(SHINGLE_WORDS, len(words))
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_digest
    made = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())])
    return np.unique(np.frombuffer(made, ">u8").astype(np.uint64))


class Signer:
    """Signatures, band keys and bits of sets."""

    def __init__(self, rows: int) -> None:
        rnd = np.random.Generator(np.random.PCG64(SEED))
        # Place of every bin in each bin's own random order of donors.
        self.places = rnd.permuted(np.tile(np.arange(BINS, dtype=np.uint16), (BINS, 1)), axis=1)
        odd = rnd.integers(0, 1 << 63, (2, BINS), np.uint64) * np.uint64(2) + np.uint64(1)
        self.joints, self.mixers = odd
        self.rows, self.bands = rows, BINS // rows

    def signature(self, found: np.ndarray) -> np.ndarray:
        """The value of each bin of a set that is not empty."""
        bins = (found >> _SHIFT).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
        values = np.zeros(BINS, np.uint64)
        full = bins[first]
        values[full] = found[first]
        empty = np.ones(BINS, bool)
        empty[full] = False
        lacking = np.flatnonzero(empty)
        if len(lacking):
            donors = full[self.places[lacking[:, None], full[None, :]].argmin(1)]
            values[lacking] = values[donors]
        return values

    def keys(self, values: np.ndarray) -> np.ndarray:
        """One key a band; factors differ by band, so equal values in two bands give different keys."""
        used = self.rows * self.bands
        joined = (values[:used] * self.joints[:used]).reshape(self.bands, self.rows).sum(1, dtype=np.uint64)
        return ((joined ^ joined >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)

    def bits(self, values: np.ndarray) -> np.ndarray:
        """One bit for each bin, equal for equal values and for half of the others."""
        return np.packbits(values * self.mixers >> np.uint64(63)).view(np.int64)


_NO_LONGS = np.zeros(0, np.int64)


def _halves(found: np.ndarray) -> tuple[int, int]:
    """A 128-bit digest of a set."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), ">i8").tolist())


def _signed(rows: int) -> object:
    signer = Signer(rows)

    def step(texts: list[bytes | None]) -> list[Sequence]:
        sets = [shingle_set(t) for t in texts]
        signatures = [signer.signature(s) if len(s) else None for s in sets]
        halves = [_halves(s) for s in sets]
        return [
            [len(s) for s in sets], [h[0] for h in halves], [h[1] for h in halves],
            [_NO_LONGS if v is None else signer.keys(v) for v in signatures],
            [_NO_LONGS if v is None else signer.bits(v) for v in signatures],
        ]

    return step


def _place_bits(found: np.ndarray) -> np.ndarray:
    """One bit for each of the places that hashes of the set fall on."""
    held = np.zeros(PLACES, bool)
    held[(found >> np.uint64(20)).astype(np.int64) % PLACES] = True
    return np.packbits(held).view(np.int64)


def _members() -> object:
    def step(texts: list[bytes | None]) -> list[Sequence]:
        sets = [shingle_set(t) for t in texts]
        halves = [_halves(s) for s in sets]
        return [[h[0] for h in halves], [h[1] for h in halves], [_place_bits(s) for s in sets], [s.view(np.int64) for s in sets]]

    return step


def _longs(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.LongType()))


_DIGEST = [T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())]


def _sized(table: DataFrame) -> DataFrame:
    """The table to be broadcast if it is small enough, else to be joined by shuffle."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _reaches(shared: Column, size_a: Column, size_b: Column, similar: tuple[int, int]) -> Column:
    """Whether sets of these sizes with so many members in common are a link."""
    return similar[1] * shared >= similar[0] * (size_a + size_b - shared)


def _bits_allow(a: Column, b: Column, similar: tuple[int, int]) -> Column:
    """Whether the bits of two sets differ in as few bins as those of a link do."""
    apart = (1 - similar[0] / similar[1]) / 2
    most = math.ceil(BINS * apart + DEVIATIONS * math.sqrt(BINS * apart * (1 - apart)))
    return sum((F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(_WORDS)), F.lit(0)) <= most


def _places_allow(a: str, b: str, similar: tuple[int, int]) -> Column:
    """Whether as many members may be shared as a link needs: never false for a link.

    A member on a place that the other set has none on is not shared, and every
    such place holds one member at least.
    """
    both = sum((F.bit_count(F.get(f"{a}_places", i).bitwiseAND(F.get(f"{b}_places", i))) for i in range(PLACES // 64)), F.lit(0))
    most = F.least(*(F.col(f"{x}_n") - F.col(f"{x}_marked") + both for x in (a, b)))
    return _reaches(most, F.col(f"{a}_n"), F.col(f"{b}_n"), similar)


def _verified(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are a link."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("_of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("_of_b"))
    shared = F.size(F.array_intersect("_of_a", "_of_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_reaches(shared, F.size("_of_a"), F.size("_of_b"), similar)).select("a", "b")


def _hubs(buckets: DataFrame) -> DataFrame:
    """Rows (key, hub): the member that meets the most others over all its buckets, the least of such."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("_size"))
    weights = buckets.join(sizes, "key").groupBy("node").agg(F.sum("_size").alias("_weight"))
    heaviest = F.max(F.struct("_weight", (-F.col("node")).alias("_node"))).alias("_h")
    return buckets.join(weights, "node").groupBy("key").agg(heaviest).select("key", (-F.col("_h._node")).alias("hub"))


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*("key",) * ("key" in rows.columns), *(F.col(c).alias(f"{name}_{c}") for c in rows.columns if c != "key"))


def _across(rest: DataFrame, sets: DataFrame, facts: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Pairs of different groups that share a bucket and that nothing but the full sets can rule out."""
    marked = sum((F.bit_count(F.get("places", i)) for i in range(PLACES // 64)), F.lit(0))
    about = facts.join(sets.select("node", "places", marked.alias("marked")), "node")
    full = materialise(rest.join(about, "node").select("key", "node", "group", "n", "marked", "places", "bits"), "meeting")
    return _side(full, "a").join(_side(full, "b"), "key").where(
        (F.col("a_group") < F.col("b_group")) & _places_allow("a", "b", similar)
        & _bits_allow(F.col("a_bits"), F.col("b_bits"), similar)
    ).select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similar: tuple[int, int] = SIMILAR
) -> tuple[DataFrame, DataFrame]:
    """Rows (key, n, d1, d2) of ``docs``, d1 and d2 naming the set, and (d1, d2, least key) of sets that have company.

    Those are the sets of several rows and the sets with links; texts without words have n = 0 and no company.
    """
    rows = band_rows(similar)
    fields = [T.StructField("n", T.IntegerType()), *_DIGEST, _longs("keys"), _longs("bits")]
    signed = materialise(with_texts(docs, [key], text, fields, lambda: _signed(rows)), "signed")
    worded = signed.where("n > 0")
    nodes = worded.groupBy("d1", "d2").agg(F.min(key).alias("first"), F.count("*").alias("copies"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    # Half of the digest tells sets apart here; copies meet in the partial aggregate.
    keys = worded.select("d1", "d2", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("d1").alias("_low"), F.max("d1").alias("_high")).where("_low < _high").select("key")
    buckets = keys.join(_sized(materialise(shared, "shared")), "key").distinct()
    buckets = materialise(buckets.join(nodes, ["d1", "d2"]).select("key", "node", "d1", "d2"), "buckets")
    wanted = materialise(buckets.select("node", "d1", "d2").distinct().join(nodes.select("node", "first"), "node"), "wanted")
    buckets = buckets.select("key", "node")
    digests = _sized(wanted.select("d1", "d2", "node"))
    facts = materialise(worded.join(digests, ["d1", "d2"]).select("node", "n", "bits").distinct(), "facts")

    hubs = _hubs(buckets)
    stars = buckets.join(hubs, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    stars = stars.join(_side(facts, "_a"), F.col("a") == F.col("_a_node")).join(_side(facts, "_b"), F.col("b") == F.col("_b_node"))
    smaller = F.least("_a_n", "_b_n")
    allowed = _reaches(smaller, F.col("_a_n"), F.col("_b_n"), similar) & _bits_allow(F.col("_a_bits"), F.col("_b_bits"), similar)
    stars = materialise(stars.where(allowed).select("a", "b"), "stars")

    firsts = _sized(wanted.select(F.col("first").alias("_first")).distinct())
    near = docs.select(docs[f"`{key}`"].alias("_key"), docs[f"`{text}`"].alias("_text"))
    near = near.join(firsts, F.col("_key").eqNullSafe(F.col("_first")), "left_semi")
    sets = with_texts(near, ["_key"], "_text", [*_DIGEST, _longs("places"), _longs("members")], _members)
    sets = sets.join(wanted, ["d1", "d2"]).where(F.col("_key").eqNullSafe(F.col("first")))
    sets = materialise(sets.select("node", "places", "members").distinct(), "sets")

    links = materialise(_verified(stars, sets, similar), "links")
    first = materialise(components(links).withColumnRenamed("root", "group"), "first")
    grouped = buckets.join(first, "node", "left").select("key", "node", F.coalesce("group", "node").alias("group"))
    grouped = materialise(grouped, "grouped")
    open_keys = grouped.groupBy("key").agg(F.min("group").alias("_low"), F.max("group").alias("_high")).where("_low < _high")
    rest = materialise(grouped.join(open_keys.select("key"), "key", "left_semi"), "rest")
    joined = first.select(F.col("node").alias("a"), F.col("group").alias("b"))
    if not rest.isEmpty():
        more = materialise(_across(rest, sets, facts, similar), "across")
        joined = joined.unionByName(_verified(more, sets, similar))
    found = materialise(components(joined), "found")

    root = F.coalesce("root", "node")
    company = materialise(nodes.join(found, "node", "left").where("root is not null or copies > 1").withColumn("root", root), "company")
    least = company.groupBy("root").agg(F.min("first").alias("least"))
    return signed.select(key, "n", "d1", "d2"), materialise(company.join(least, "root").select("d1", "d2", "least"), "least")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """Rows (key, n_shingles, component_id, kept) for every row of ``docs``.

    ``component_id`` is the least ``key`` reachable over links, the row's own
    included, and ``kept`` says whether it is the row's own.  Texts without words,
    null ones too, have no shingles and link with none.  Null keys take part; a
    class of null keys only has a null id.  Rows that repeat exactly come out
    equal; an empty table gives no rows; other columns are not read.  A link is
    missed with a chance of ``MISS`` at the least similarity, and less above it.
    """
    rows, company = classes(docs.select(key, text), key, text, similar)
    found = rows.join(_sized(company), ["d1", "d2"], "left")
    least = F.when(F.col("n") > 0, F.coalesce("least", key)).otherwise(F.col(key))
    found = found.select(key, F.col("n").cast("long").alias("n_shingles"), least.alias("component_id"))
    return found.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """The distinct keys of rows in the class of one with a lesser key; keys may be structs."""
    rows, company = classes(docs, key, text, similar)
    rooted = rows.where("n > 0").join(_sized(company), ["d1", "d2"])
    return rooted.where(~F.col(key).eqNullSafe(F.col("least"))).select(key).distinct()
