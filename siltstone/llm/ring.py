"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``CELLS`` equal cells.  A key's hash names its cell, and the
cell belongs to the next virtual node clockwise.  Every shard has a bound, and
the bounds add up to the number of rows, so counts are at most one apart.  Keys
that find their shard full continue clockwise to the next virtual node whose
shard has room.

Which rows overflow is settled on the counts of the cells alone, whose number is
fixed.  Rows then find their shard by their rank within their cell, in the order of
their keys' hashes, so it does not depend on how the table is read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.operators.slices import POSITION, SLICE, slice_offsets, sorted_slices
from siltstone.session import materialise

SHARDS = 40
VIRTUAL_NODES = 64
CELL_BITS = 14
CELLS = 1 << CELL_BITS

Piece = tuple[int, int, int, int, int]


def cell(key: Column) -> Column:
    """The ring cell of a key, from the high bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - CELL_BITS).cast("int")


def nodes(shards: int, virtual: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes, clockwise."""
    def place(shard: int, copy: int) -> int:
        return int.from_bytes(hashlib.sha256(f"{shard}/{copy}".encode()).digest()[:8], "big") >> (64 - CELL_BITS)

    return sorted((place(s, c), s) for s in range(shards) for c in range(virtual))


def settle(counts: Mapping[int, int], shards: int, virtual: int = VIRTUAL_NODES) -> list[Piece]:
    """Pieces (cell, first rank, end rank, shard, first slot) that place every row.

    Cells offer their rows to the first node clockwise, all cells before any
    offers what is left to its second node, and so on; the more distant nodes so
    get only what overflows.
    """
    total = sum(counts.values())
    ring = nodes(shards, virtual)
    places = [at for at, _ in ring]
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    left = {c: (0, n, bisect_left(places, c)) for c, n in sorted(counts.items()) if n}
    pieces: list[Piece] = []
    while left:
        after = {}
        for c, (rank, n, node) in left.items():
            shard = ring[node % len(ring)][1]
            taken = min(n - rank, room[shard])
            if taken:
                pieces.append((c, rank, rank + taken, shard, filled[shard]))
                room[shard] -= taken
                filled[shard] += taken
            if rank + taken < n:
                after[c] = (rank + taken, n, node + 1)
        left = after
    return pieces


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Rows (key, size, text_crc32, shard, slot) for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 16, null counting as empty.  Counts of
    shards differ by one at most, and slots run from 0 without gaps.  Null keys
    hash like a value of their own; repeated rows are placed one by one; an empty
    table gives no rows; other columns are not read.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    rows = materialise(docs.select(
        docs[f"`{key}`"].alias("_key"), (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), cell(docs[f"`{key}`"]).alias("_cell"),
        F.xxhash64(docs[f"`{key}`"]).alias("_hash"),
    ), "ring")
    counted = {r["_cell"]: r["n"] for r in rows.groupBy("_cell").agg(F.count("*").alias("n")).collect()}
    begins = dict(zip(sorted(counted), accumulate((counted[c] for c in sorted(counted)), initial=0)))
    pieces = [(c, begins[c] + a, begins[c] + b, shard, slot) for c, a, b, shard, slot in settle(counted, shards)]
    table = docs.sparkSession.createDataFrame(pieces, "_cell int, _from long, _to long, shard int, _slot long")

    # The last column tells repeated rows apart, so that a key of any frequency spreads over slices.
    order = ["_cell", "_hash", "_key", "text_crc32", "size", "_row"]
    sliced = sorted_slices(rows.withColumn("_row", F.monotonically_increasing_id()), order)
    ranked = sliced.join(F.broadcast(slice_offsets(sliced)), SLICE).withColumn("_rank", F.col("_offset") + F.col(POSITION))
    # At most one piece for each cell and overflow step: a size fixed by the ring, not by the rows.
    placed = ranked.join(F.broadcast(table), "_cell").where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    slot = (F.col("_slot") + F.col("_rank") - F.col("_from")).cast("long")
    return placed.select(F.col("_key").alias(key), "size", "text_crc32", "shard", slot.alias("slot"))
