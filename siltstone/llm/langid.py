"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1.  A trigram is the product of its
letters' vectors, the first two rotated by two places and one, so that order
counts; a text is the sum of its trigrams; a language's prototype is the sum of
the unit vectors of labelled texts.  A text belongs to the prototype with the
greatest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from siltstone.llm.arrow import SLICE_ROWS, importable, texts, with_texts
from siltstone.session import materialise

DIMENSIONS = 1024
SEED = 20240

#: Labelled texts of a language that its prototype is learnt from, at most.
TRAIN_ROWS = 400
#: Whole units that a unit vector is rounded to, so that sums do not depend on their order.
UNIT = 1_000_000

#: Parts that a language's labelled texts are thinned in before they meet.
SALTS = 64

UNKNOWN = "und"

#: Letter classes: 0 stands between words, 1 to 26 are a to z, the rest share other letters.
CLASSES = 64


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.int32)
    points = np.fromiter((c for c in range(0x110000) if chr(c).isalpha()), np.int64)
    table[points] = 27 + (points * 2654435761 >> 7) % (CLASSES - 27)
    table[97:123] = np.arange(1, 27)
    return table


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters' vectors, rotated by two places, by one, and as they are."""
    signs = np.random.default_rng(SEED).integers(0, 2, (CLASSES, DIMENSIONS), dtype=np.int8) * 2 - 1
    plain = signs.astype(np.float32)
    return np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1), plain


def trigrams(text: bytes | None) -> np.ndarray:
    """Codes of the trigrams of a text's words, runs of anything but letters being one gap."""
    points = np.frombuffer((text or b"").decode().lower().encode("utf-32-le"), np.uint32)
    classes = np.concatenate([[0], letter_classes()[points], [0]]).astype(np.int32)
    classes = classes[np.concatenate([[True], (classes[1:] != 0) | (classes[:-1] != 0)])]
    if len(classes) < 3:
        return np.zeros(0, np.int32)
    return classes[:-2] << 12 | classes[1:-1] << 6 | classes[2:]


def vectors(batch: Sequence[bytes | None]) -> np.ndarray:
    """One row for each text, whole numbers; zeros for a text without letters."""
    grams = [trigrams(t) for t in batch]
    flat = np.concatenate([*grams, np.zeros(0, np.int32)])
    rows = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    seen = np.zeros(CLASSES**3, bool)
    seen[flat] = True
    used = np.flatnonzero(seen)
    place = np.zeros(CLASSES**3, np.int64)
    place[used] = np.arange(len(used))
    out = np.zeros((len(grams), DIMENSIONS), np.float32)
    first, second, third = _letters()
    for at in range(0, len(used), 8192):
        part = used[at : at + 8192]
        inside = (place[flat] >= at) & (place[flat] < at + len(part))
        counts = np.bincount(rows[inside] * len(part) + place[flat[inside]] - at, minlength=len(grams) * len(part))
        bound = first[part >> 12] * second[part >> 6 & 63] * third[part & 63]
        out += counts.reshape(len(grams), -1).astype(np.float32) @ bound
    return out


def _unit(found: np.ndarray) -> np.ndarray:
    wide = found.astype(np.float64)
    return wide / np.maximum(np.linalg.norm(wide, axis=1, keepdims=True), 1e-12)


def bounded(docs: DataFrame, key: str, group: str, most: int) -> DataFrame:
    """At most ``most`` rows of each group, those with the least hash of ``key``; only the two columns are read.

    A group is first thinned within ``SALTS`` parts, so that no task meets more
    of a large one than a fixed number of rows.
    """
    spread = F.xxhash64(F.col(key).cast("string"))
    rows = docs.select(key, group).where(F.col(key).isNotNull() & F.col(group).isNotNull())
    rows = rows.withColumns({"_hash": spread, "_salt": F.pmod(spread, F.lit(SALTS))})
    for cut in (["_salt", group], [group]):
        order = Window.partitionBy(*cut).orderBy("_hash", key)
        rows = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n")
    return rows.drop("_hash", "_salt")


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """The unit prototype of each language, from ``most`` labelled texts of it at most.

    Rows without key, text, language or letters teach nothing.
    """
    importable(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").alias("lang"))
    picked = materialise(bounded(rows, "key", "lang", most).distinct(), "picked")
    rows = rows.join(picked, ["key", "lang"], "left_semi").select("lang", "text")
    schema = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("place", T.IntegerType()), T.StructField("weight", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                whole = np.rint(_unit(vectors(texts(piece.column(1)))) * UNIT).astype(np.int64)
                names = np.array(piece.column(0).to_pylist(), object)
                for name in set(names):
                    sums[name] = sums.get(name, 0) + whole[names == name].sum(0)
        for name, total in sums.items():
            columns = [pa.array([name] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    totals = rows.mapInArrow(run, schema).groupBy("lang", "place").agg(F.sum("weight").alias("weight")).collect()
    found: dict[str, np.ndarray] = {}
    for row in totals:
        found.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["place"]] = row["weight"]
    return {name: v / np.linalg.norm(v) for name, v in sorted(found.items()) if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep``, ``lang_pred`` and ``score`` for every row's whole text.

    The score is the cosine, negative ones being zero.  Without letters, or
    without prototypes, the language is ``und`` and the score zero; ties go to
    the first name.  Repeated rows are judged alike; other columns are not read.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), DIMENSIONS).T

    def step(batch: list[bytes | None]) -> list[Sequence]:
        found = vectors(batch)
        some = found.any(axis=1)
        if not names:
            return [[UNKNOWN] * len(batch), np.zeros(len(batch))]
        # The tie of two equal cosines must not hang on the last bit of a sum.
        cosines = np.round(_unit(found) @ matrix, 9)
        best = cosines.argmax(axis=1)
        score = np.where(some, np.clip(cosines[np.arange(len(batch)), best], 0, 1), 0.0)
        return [[names[b] if s else UNKNOWN for b, s in zip(best, some)], score]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return with_texts(docs, keep, text, fields, lambda: step)


def remainder(key: Column, modulus: int) -> Column:
    """The CRC-32 of a key's text, modulo; a null key counts as empty."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % modulus
