"""Hard negatives by exact inner product search over length buckets with coordinate pruning.

Rows are dealt by vector length and packed into blocks, and a block into buckets
of similar length.  A bucket keeps, for every coordinate, its rows in the order of
that coordinate of the unit vector.  If an anchor's score with a row must be
``bound`` or more, the cosine must be at least bound / (anchor's length * longest of
the bucket).  Buckets for which that is over 1 are left out.  Else the angle between
the two lies below a limit, so each coordinate of the row's unit vector must lie in
a range around the anchor's.  For the anchor's largest (focus) coordinates these
ranges are slices of the sorted lists, and only rows in all slices are verified,
by their exact score.  Pruning never loses a row: results are those of brute force.

Two searches are made.  The first gives each anchor its best rows of the same
label, its bound being the worst of the best so far.  The second gives each pair of
anchor and positive the best rows of other labels whose score lies in a band
relative to the positive's; its bound rises from the band's foot in the same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from siltstone.llm.arrow import importable
from siltstone.session import materialise

#: A component x counts as floor(SCALE * x).
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these hundredths of its positive's.
BAND = (30, 90)

#: Vector components in a block of rows (4 MB) and in a block of anchors (1 MB), and rows of a bucket.
BLOCK_VALUES = 1 << 19
ANCHOR_VALUES = 1 << 17
BUCKET_ROWS = 1_024
FOCUS = 4

#: Bytes of anchors that are broadcast at most; more are joined by shuffle.
BROADCAST_BYTES = 64 << 20

#: More than what rounding can move a unit vector's coordinate or a cosine.
_SLACK = 1e-6
#: Sums of whole numbers up to this are exact in a double.
_EXACT = float(1 << 53)
_LONG = (-(1 << 63), (1 << 63) - 1)

_BLOCK = "n int, dims int, ids binary, labels binary, matrix binary, orders binary"
_INDEX = np.dtype("<u2")


def usable(vector: Column) -> Column:
    """Whether there is a vector and all its components are finite, scaled too."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(SCALE * x) != F.lit(float("inf"))))
    return vector.isNotNull() & finite


def rows_of(table: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """Columns id, label and v of the rows that take part."""
    source = table.select(
        table[f"`{key}`"].cast("long").alias("id"), label.cast("long").alias("label"), table[f"`{vector}`"].cast("array<double>").alias("v")
    )
    return source.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))


def _lengths(matrix: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((matrix * matrix).sum(1))


def _directions(matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unit vectors; zero where there is no length."""
    return np.divide(matrix, lengths[:, None], out=np.zeros_like(matrix), where=lengths[:, None] > 0)


def _block(ids: list, labels: list, vectors: list, indexed: bool) -> list:
    """One row for a block, longest vectors first."""
    dims = max(map(len, vectors))
    matrix = np.zeros((len(ids), dims))
    for row, v in zip(matrix, vectors):
        row[: len(v)] = v
    order = np.lexsort((np.array(ids), -_lengths(matrix)))
    matrix = matrix[order]
    orders = b""
    if indexed:
        unit = _directions(matrix, _lengths(matrix))
        pieces = (unit[at : at + BUCKET_ROWS] for at in range(0, len(unit), BUCKET_ROWS))
        orders = b"".join(p.argsort(0, "stable").T.astype(_INDEX).tobytes() for p in pieces)
    sides = (np.array(x, "<i8")[order].tobytes() for x in (ids, labels))
    return [len(ids), dims, *sides, matrix.tobytes(), orders]


def _packed(rows: DataFrame, values: int, indexed: bool) -> DataFrame:
    """Blocks of at most ``values`` components, or one row; a row that repeats exactly is packed once."""
    importable(rows.sparkSession)
    total = rows.agg(F.sum(F.size("v").cast("long") + 1)).first()[0] or 0
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = [part.split()[0] for part in _BLOCK.split(",")]

    def made(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        arrays = [pa.array([x], k) for x, k in zip(_block(ids, labels, vectors, indexed), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, held, last = [], [], [], 0, None
        for batch in batches:
            lists = batch.column(2)
            flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False))
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            for i, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), np.split(flat, ends[:-1])):
                this = (i, label, v.tobytes())
                if this == last:
                    continue
                if ids and held + len(v) + 1 > values:
                    yield made(ids, labels, vectors)
                    ids, labels, vectors, held = [], [], [], 0
                ids.append(i)
                labels.append(label)
                vectors.append(v)
                held += len(v) + 1
                last = this
        if ids:
            yield made(ids, labels, vectors)

    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    dealt = rows.withColumn("_l", length).repartitionByRange(max(1, math.ceil(total / values)), F.desc("_l"), "id")
    dealt = dealt.sortWithinPartitions(F.desc("_l"), "id", "label", "v").select("id", "label", "v")
    return dealt.mapInArrow(run, _BLOCK)


class Bucket:
    """Rows of similar length and, for each coordinate, their order by it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, orders: np.ndarray) -> None:
        self.ids, self.labels, self.matrix, self.orders = ids, labels, matrix, orders
        lengths = _lengths(matrix)
        self.longest = float(lengths[0])
        self.sorted = np.take_along_axis(_directions(matrix, lengths).T, orders.astype(np.int64), 1)

    def within(self, anchor: np.ndarray, length: float, bound: float) -> np.ndarray | None:
        """Indices of the rows whose score can be ``bound`` or more; None if no row's can."""
        most = length * self.longest
        if bound <= 0 or not math.isfinite(most):
            return np.arange(len(self.ids))
        cosine = bound / most - _SLACK if most > 0 else 2.0
        if cosine > 1:
            return None
        wide = math.acos(cosine)
        focus = np.argsort(-np.abs(anchor))[:FOCUS]
        seen = np.zeros(len(self.ids), np.uint8)
        for f in focus.tolist():
            angle = math.acos(max(-1.0, min(1.0, anchor[f] / length)))
            low = math.cos(min(math.pi, angle + wide)) - _SLACK
            high = math.cos(max(0.0, angle - wide)) + _SLACK
            a, b = np.searchsorted(self.sorted[f], (low, high), "left")
            seen[self.orders[f, a:b]] += 1
        return np.flatnonzero(seen == len(focus))

    def scores(self, rows: np.ndarray, anchor: np.ndarray, length: float) -> np.ndarray:
        """Exact scores, those beyond a long as the nearest one."""
        if length * self.longest < _EXACT:
            return (self.matrix[rows] @ anchor).astype(np.int64)
        exact = [int(x) for x in anchor]
        whole = (sum(int(x) * y for x, y in zip(r, exact) if x) for r in self.matrix[rows])
        return np.array([min(max(x, _LONG[0]), _LONG[1]) for x in whole], np.int64)


def _buckets(block: dict, dims: int) -> Iterator[Bucket]:
    """The buckets of a block, longest first, over its first ``dims`` coordinates."""
    n, width = block["n"], block["dims"]
    ids, labels = (np.frombuffer(block[c], "<i8") for c in ("ids", "labels"))
    matrix = np.frombuffer(block["matrix"], "<f8").reshape(n, width)
    orders = np.frombuffer(block["orders"], _INDEX)
    for at in range(0, n, BUCKET_ROWS):
        end = min(at + BUCKET_ROWS, n)
        order = orders[at * width : end * width].reshape(width, end - at)
        yield Bucket(ids[at:end], labels[at:end], matrix[at:end, :dims], order[:dims])


class Best:
    """The best of what it is shown: greatest score first, then least id."""

    def __init__(self, size: int) -> None:
        self.size, self.ids, self.scores = size, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(ids):
            ids, scores = np.concatenate((self.ids, ids)), np.concatenate((self.scores, scores))
            # ~x falls as x rises, for the least long too.
            order = np.lexsort((ids, ~scores))[: self.size]
            self.ids, self.scores = ids[order], scores[order]

    def worst(self) -> int | None:
        """The score that a further row must reach; None while there is room."""
        return int(self.scores[-1]) if len(self.ids) == self.size else None


def positives_of(block: dict, anchors: dict, size: int) -> Iterator[tuple]:
    """(anchor's place, ids, scores) of the best rows of its label in a block, but for rows of its own id."""
    n, width = anchors["n"], anchors["dims"]
    dims = min(width, block["dims"])
    ids, labels = (np.frombuffer(anchors[c], "<i8") for c in ("ids", "labels"))
    matrix = np.frombuffer(anchors["matrix"], "<f8").reshape(n, width)
    lengths = _lengths(matrix)
    found = [Best(size) for _ in range(n)]
    for bucket in _buckets(block, dims):
        by_label = {}
        for i in range(n):
            bound = found[i].worst()
            anchor, length = matrix[i, :dims], float(lengths[i])
            if bound is None or bound <= 0:
                label = int(labels[i])
                if label not in by_label:
                    by_label[label] = np.flatnonzero(bucket.labels == label)
                rows = by_label[label]
            else:
                rows = bucket.within(anchor, length, float(bound))
                if rows is None:
                    continue
                rows = rows[bucket.labels[rows] == labels[i]]
            rows = rows[bucket.ids[rows] != ids[i]]
            if len(rows):
                found[i].add(bucket.ids[rows], bucket.scores(rows, anchor, length))
    for i, best in enumerate(found):
        if len(best.ids):
            yield i, best.ids, best.scores


def negatives_of(block: dict, anchors: dict, band: tuple[int, int], size: int) -> Iterator[tuple]:
    """(anchor's place, positive's place, ids, scores) of the best rows of other labels in the band.

    ``anchors["wants"]`` names the positives of each anchor.
    """
    n, width = anchors["n"], anchors["dims"]
    dims = min(width, block["dims"])
    labels = np.frombuffer(anchors["labels"], "<i8")
    matrix = np.frombuffer(anchors["matrix"], "<f8").reshape(n, width)
    lengths = _lengths(matrix)
    wants: dict[int, list] = {}
    for want in anchors["wants"]:
        feet, top = -(-band[0] * want["score"] // 100), band[1] * want["score"] // 100
        if feet <= top:
            wants.setdefault(want["at"], []).append((want["rank"], feet, top, Best(size)))
    for bucket in _buckets(block, dims):
        for i, list_of in wants.items():
            anchor, length = matrix[i, :dims], float(lengths[i])
            least = min(foot if (worst := best.worst()) is None else max(foot, worst) for _, foot, _, best in list_of)
            rows = bucket.within(anchor, length, float(least))
            if rows is None:
                continue
            rows = rows[bucket.labels[rows] != labels[i]]
            if not len(rows):
                continue
            scores = bucket.scores(rows, anchor, length)
            near = scores >= least
            rows, scores = rows[near], scores[near]
            for _, foot, top, best in list_of:
                inside = np.flatnonzero((scores >= foot) & (scores <= top))
                best.add(bucket.ids[rows[inside]], scores[inside])
    for i, list_of in wants.items():
        for rank, _, _, best in list_of:
            if len(best.ids):
                yield i, rank, best.ids, best.scores


def _sized(blocks: DataFrame) -> DataFrame:
    """The blocks to be broadcast if they are small enough, else to be joined by shuffle."""
    size = blocks.agg(F.sum(F.length("matrix") + F.length("ids") + F.length("labels"))).first()[0] or 0
    return F.broadcast(blocks) if size <= BROADCAST_BYTES else blocks


def _searched(blocks: DataFrame, anchors: DataFrame, schema: str, search: Callable[[dict, dict], Iterator[tuple]]) -> DataFrame:
    """Every block of rows searched for every block of anchors (column ``cell`` numbers these).

    Results get the anchor's cell and its place there.
    """
    cells = [r["cell"] for r in anchors.select("cell").collect()]
    left = blocks.select(F.struct("n", "dims", "ids", "labels", "matrix", "orders").alias("block"), F.explode(F.lit(cells)).alias("cell"))
    pairs = left.join(_sized(anchors), "cell").select("cell", "block", F.struct(*(c for c in anchors.columns if c != "cell")).alias("anchors"))
    names = ["cell", "at", *(part.split()[0] for part in schema.split(","))]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    types = [pa.int64(), pa.int32(), *(kinds[part.split()[1]] for part in schema.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cell, block, sought = (batch.column(c)[k].as_py() for c in range(3))
                made = [[] for _ in names]
                for at, *fixed, ids, scores in search(block, sought):
                    columns = [[x] * len(ids) for x in (cell, at, *fixed)]
                    for into, values in zip(made, (*columns, ids.tolist(), scores.tolist())):
                        into.extend(values)
                yield pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, types)], names=names)

    return pairs.mapInArrow(run, f"cell long, at int, {schema}")


def _ranked(found: DataFrame, groups: list[str], score: str, key: str, size: int) -> DataFrame:
    """The best of each group, with their rank from 1."""
    best = Window.partitionBy(*groups).orderBy(F.desc(score), key)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that meet ``is_anchor``, a condition on the column
    ``id``.  An anchor's positives are its first ``positives`` other rows of the
    same label; for each, the first ``negatives`` rows of other labels with
    band[0] * positive_score <= 100 * score <= band[1] * positive_score are returned.
    Greater scores come first, ties by lesser id.  ``label`` is a whole number.

    Rows with a null id, label or vector or with a component that is null or,
    scaled, not finite take no part.  A row that repeats exactly counts once; rows that only
    share their id are rows of their own, but no positives of each other.  Of
    vectors of different sizes the shorter has zeros where it ends; an empty one
    scores zero.  Scores beyond a long count as the nearest long.  No anchors or no
    rows give no rows; other columns are not read.
    """
    spark = rows.sparkSession
    source = rows_of(rows, key, vector, F.col(label) if isinstance(label, str) else label)
    blocks = materialise(_packed(source, BLOCK_VALUES, True), "blocks")
    anchors = _packed(source.where(is_anchor), ANCHOR_VALUES, False).drop("orders")
    anchors = materialise(anchors.withColumn("cell", F.monotonically_increasing_id()), "anchors")
    if anchors.isEmpty():
        return _nothing(spark)

    found = _searched(blocks, anchors, "id long, score long", lambda block, sought: positives_of(block, sought, positives))
    best = materialise(_ranked(found, ["cell", "at"], "score", "id", positives), "positives")
    wants = best.groupBy("cell").agg(F.collect_list(F.struct("at", "rank", "score")).alias("wants"))
    wanting = materialise(anchors.join(wants, "cell"), "wanting")
    if wanting.isEmpty():
        return _nothing(spark)
    schema = "positive int, id long, score long"
    found = _searched(blocks, wanting, schema, lambda block, sought: negatives_of(block, sought, band, negatives))
    hard = _ranked(found, ["cell", "at", "positive"], "score", "id", negatives)
    hard = hard.select("cell", "at", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = best.select("cell", "at", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(named, ["cell", "at", "positive"]).join(_sized_ids(anchors), ["cell", "at"]).select(*_COLUMNS)


_COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType([
        T.StructField(c, T.IntegerType() if c == "rank" else T.LongType()) for c in _COLUMNS
    ]))


def _sized_ids(anchors: DataFrame) -> DataFrame:
    """The id of each anchor by its cell and place."""
    importable(anchors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(ids, "<i8")
                columns = [np.full(len(found), cell), np.arange(len(found), dtype=np.int32), found]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "at", "anchor_id"])

    return anchors.select("cell", "ids").mapInArrow(run, "cell long, at int, anchor_id long")
