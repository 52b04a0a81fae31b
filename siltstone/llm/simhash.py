"""Near-duplicates by SimHash, their fingerprints joined through Golay-code keys.

A fingerprint's 64 bits are cut into segments of 22, 21 and 21 bits.  If two
fingerprints differ in four bits or fewer, then either

* one segment is equal and another differs in at most two bits, or
* two segments differ in exactly one bit each.

In the first case they share a key made of the equal segment and a codeword
index near the other.  In the second their segments have opposite parity: the
even word of a pair gives all its near indices, the odd word its nearest one,
and the two agree in both segments.  So every link is found, from about sixty
keys of 33 or 24 bits for a fingerprint, and each candidate is verified.

Copies of a fingerprint are joined as one.  Within a bucket of keys every
fingerprint is first compared with the least one only; what that joins is not
compared again, so a dense group never meets itself pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from siltstone.llm import golay
from siltstone.llm.arrow import importable, with_texts
from siltstone.llm.components import components
from siltstone.session import materialise

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4

#: Shift and width of the three segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))

_CHUNK = 1 << 16

#: Shared keys that are broadcast at most (16 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def fingerprint(text: bytes | None, size: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of one text; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(size, len(words))
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest, seed = xxhash.xxh64_digest, SEED
    hashes = np.frombuffer(
        b"".join([digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist())]), np.uint8
    ).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        counts += np.unpackbits(hashes[at : at + _CHUNK], axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _fingerprints() -> object:
    def step(texts: list[bytes | None]) -> list[Sequence]:
        return [np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)]

    return step


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``key`` and the 64-bit fingerprint of each row's whole text (null and wordless texts: zero)."""
    return with_texts(docs, [key], text, [T.StructField(name, T.LongType())], _fingerprints)


def _product(classes: int, left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Keys (class, left, right) of all combinations, and the row each belongs to."""
    (a, n_a), (b, n_b) = left, right
    i, j = np.divmod(np.arange(a.shape[1] * b.shape[1]), b.shape[1])
    there = (i[None, :] < n_a[:, None]) & (j[None, :] < n_b[:, None])
    keys = classes[:, None] << 40 | a[:, i].astype(np.int64) << 12 | b[:, j]
    rows = np.broadcast_to(np.arange(len(a))[:, None], keys.shape)
    return keys[there], rows[there]


def golay_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the index of the fingerprint each belongs to, and its side.

    Sides 0 and 1 look for each other; side 2 looks for any other row.
    """
    bits = [(values >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    odd = [np.bitwise_count(x).astype(np.int64) & 1 for x in bits]
    near = [golay.near(x) for x in bits]
    one = np.ones(len(values), np.int64)
    keys, rows, sides = [], [], []
    for x in range(3):
        for y in range(3):
            if x != y:
                k, r = _product(one * (3 * x + y), (bits[x][:, None], one), near[y])
                keys.append(k)
                rows.append(r)
                sides.append(np.full(len(k), 2, np.int8))
            if x < y:
                ends = [(near[s][0], np.where(odd[s] == 1, 1, near[s][1])) for s in (x, y)]
                k, r = _product(9 + 2 * (x + y - 1) + (odd[x] ^ odd[y]), *ends)
                keys.append(k)
                rows.append(r)
                sides.append(odd[x][r].astype(np.int8))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(sides)


def _keyed(prints: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each key of each row's fingerprint ``fp``."""
    importable(prints.sparkSession)
    kept = [prints.schema[c] for c in columns]
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("side", T.ByteType()), *kept])
    at = list(columns).index("fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                piece = batch.slice(begin, 4096)
                values = piece.column(at).to_numpy(zero_copy_only=False).view(np.uint64)
                keys, rows, sides = golay_keys(values)
                taken = piece.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sides), *taken.columns], names=schema.names)

    return prints.select(*columns).mapInArrow(run, schema)


def _differing(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


#: Whether a bucket can hold a link: rows of both sides, or two different rows of side 2.
def _mixed(value: str):
    return (F.min("side") < F.max("side")) | ((F.min("side") == 2) & (F.min(value) < F.max(value)))


def _sized(table: DataFrame) -> DataFrame:
    """The table to be broadcast if it is small enough, else to be joined by shuffle."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def link_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (fp, root): for each linked fingerprint of the distinct column ``fp`` a common member of its class.

    Two fingerprints link at ``max_bits`` (4 at most) or fewer differing bits.
    Fingerprints without a link have no row.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys find links of four bits at most")
    keys = _keyed(prints, ["fp"])
    shared = keys.groupBy("key").agg(F.min("fp").alias("least"), _mixed("fp").alias("_mixed")).where("_mixed")
    shared = materialise(shared.select("key", "least"), "shared")
    buckets = materialise(keys.join(_sized(shared), "key"), "buckets")

    stars = buckets.where((F.col("fp") != F.col("least")) & (_differing("fp", "least") <= max_bits))
    first = materialise(components(stars.select(F.col("fp").alias("a"), F.col("least").alias("b"))), "first")

    group = F.coalesce("root", "fp").alias("group")
    grouped = buckets.drop("least").join(first.withColumnRenamed("node", "fp"), "fp", "left").select("key", "side", "fp", group)
    grouped = materialise(grouped, "grouped")
    open_keys = grouped.groupBy("key").agg(F.min("group").alias("_low"), F.max("group").alias("_high"))
    rest = materialise(grouped.join(open_keys.where("_low < _high").select("key"), "key", "left_semi"), "rest")
    a = rest.select("key", F.col("side").alias("a_side"), F.col("fp").alias("a_fp"), F.col("group").alias("a"))
    b = rest.select("key", F.col("side").alias("b_side"), F.col("fp").alias("b_fp"), F.col("group").alias("b"))
    across = a.join(b, "key").where(
        (F.col("a") < F.col("b")) & ((F.col("a_side") == 2) | (F.col("a_side") != F.col("b_side")))
        & (_differing("a_fp", "b_fp") <= max_bits)
    )
    second = components(across.select("a", "b").distinct())
    both = first.withColumnRenamed("root", "_root").join(
        second.select(F.col("node").alias("_root"), "root"), "_root", "left"
    ).select(F.col("node").alias("fp"), F.coalesce("root", "_root").alias("root"))
    single = second.join(first, "node", "left_anti").select(F.col("node").alias("fp"), "root")
    return materialise(both.unionByName(single), "classes")


def with_class(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``prints`` with ``root``, one value for all rows whose column ``fp`` is in the same class."""
    linked = link_fingerprints(prints.select("fp").distinct(), max_bits)
    return prints.join(_sized(linked), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """Rows (key, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the least ``key`` reachable over links, the row's own
    included.  Null, empty and wordless texts have the fingerprint zero and link
    like any other; null keys take part, and a class of null keys only has a
    null id; an empty table gives no rows; other columns are not read.
    """
    prints = materialise(fingerprints(docs, key, text, "fp"), "fingerprints")
    firsts = materialise(prints.groupBy("fp").agg(F.min(key).alias("_first")), "firsts")
    rooted = with_class(firsts, max_bits)
    least = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    by_print = materialise(rooted.join(least, "root").select("fp", "component_id"), "by_print")
    return prints.join(by_print, "fp").select(key, F.col("fp").alias("fingerprint"), "component_id")


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The distinct keys of rows that are a near-duplicate of one with a lesser key; keys may be structs."""
    prints = materialise(fingerprints(docs, key, text, "fp"), "fingerprints")
    rooted = materialise(with_class(prints, max_bits), "rooted")
    least = rooted.groupBy("root").agg(F.min(key).alias("_least"), F.count("*").alias("_n")).where("_n > 1")
    # Read from its table, the join has a shuffle of its own that a large class can be split in.
    return rooted.join(materialise(least.drop("_n"), "least"), "root").where(~F.col(key).eqNullSafe(F.col("_least"))).select(key).distinct()
