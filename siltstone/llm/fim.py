"""Fill-in-middle: texts cut in three at hashed places and put together in another order.

Cut places are counted in code points but texts are UTF-8.  All texts of a batch
are seen as one array of 64-bit words.  Arithmetic on a word marks, in the lowest
bit of each byte, the bytes that end a code point; bit counts of the words, summed
up, say how many units end before any word.  The byte after the k-th unit is found
by a binary search for its word and a select among the eight marks of that word,
which is arithmetic again: no text is decoded and no character visited.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltstone.llm.arrow import importable

#: Fixed values of the format: what stands before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN_PERCENT = 10
SPM_PERCENT = 20

#: Rows and bytes of text that are cut together at most; one longer text is cut alone.
SLICE_ROWS = 2_048
SLICE_BYTES = 8 << 20

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_U = np.uint64


class Units:
    """Where code points end in UTF-8 bytes."""

    def __init__(self, data: np.ndarray) -> None:
        """``data`` holds whole code points as unsigned bytes."""
        words = np.zeros(len(data) // 8 + 2, "<u8")
        words.view(np.uint8)[: len(data)] = data
        # A byte 10xxxxxx goes on with a unit; all others, the padding too, start one.
        starts = (words >> _U(7) & ~(words >> _U(6)) & _ONES) ^ _ONES
        # A byte ends a unit if the byte after it starts one.
        self.ends = starts[:-1] >> _U(8) | starts[1:] << _U(56)
        self.before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(self.ends), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many units end before each byte position."""
        word, inside = at >> 3, (at & 7).astype(np.uint64)
        below = (_U(1) << _U(8) * inside) - _U(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & below)

    def select(self, count: np.ndarray) -> np.ndarray:
        """The byte position after the ``count``-th unit, counted from 1; 0 for 0 units."""
        word = np.maximum(np.searchsorted(self.before, count, "left") - 1, 0)
        wanted = (count - self.before[word]).astype(np.uint64)
        # Byte i of the product counts the marks up to byte i; bytes that have too few stay low.
        reached = (self.ends[word] * _ONES | _HIGH) - wanted * _ONES & _HIGH
        return np.where(count == 0, 0, 8 * word + 9 - np.bitwise_count(reached))


def _checked(marks: Sequence[str]) -> tuple[str, str, str]:
    """The marks, if none can be mistaken where a piece of text and a mark meet."""
    if len(marks) != 3 or len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different marks are needed")
    for a in marks:
        for b in marks:
            if (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, len(b))):
                raise ValueError(f"marks {a!r} and {b!r} overlap")
    return tuple(marks)


def _numbers(key: Column, seed: int) -> list[Column]:
    """The first four groups of eight digits of the hash of ``seed:key``, unsigned; a null key is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _slices(batch: pa.RecordBatch, texts: pa.LargeBinaryArray) -> Iterator[tuple[int, int]]:
    """(begin, rows) of pieces within the limits."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        end = min(max(end, at + 1), at + SLICE_ROWS, batch.num_rows)
        yield at, end - at
        at = end


def cut(
    texts: pa.LargeBinaryArray, h: Sequence[np.ndarray], marks: Sequence[bytes], plain_percent: int, spm_percent: int
) -> tuple[np.ndarray, list[str], list[int | None], list[int | None], list[bytes]]:
    """Units, form, units of prefix and middle, and output of each text; ``h`` are its four numbers."""
    size = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: size + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    units = Units(data)
    ranks = units.rank(offsets)
    n = np.diff(ranks)
    places = [h[0] % (n + 1), h[1] % (n + 1)]
    first, second = np.minimum(*places), np.maximum(*places)
    # The units before a text are those of the texts before it, so the place of none is its begin.
    at_first, at_second = units.select(ranks[:-1] + first), units.select(ranks[:-1] + second)
    body = data.tobytes()
    forms, outputs = [], []
    plain, spm = h[2] % 100 >= 100 - plain_percent, h[3] % 100 < spm_percent
    p, s, m = marks
    for i, (a, b, c, d) in enumerate(zip(offsets.tolist(), at_first.tolist(), at_second.tolist(), offsets[1:].tolist())):
        whole = body[a:d]
        if plain[i] or a == d or p in whole or s in whole or m in whole:
            forms.append("plain")
            outputs.append(whole)
        elif spm[i]:
            forms.append("spm")
            outputs.append(b"".join((s, body[c:d], p, body[a:b], m, body[b:c])))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, body[a:b], s, body[c:d], m, body[b:c])))
    prefix = [None if f == "plain" else k for f, k in zip(forms, first.tolist())]
    middle = [None if f == "plain" else k for f, k in zip(forms, (second - first).tolist())]
    return n, forms, prefix, middle, outputs


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    marks: Sequence[str] = MARKS,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """Rows (key, n, form, prefix_chars, middle_chars, output), one for every row of ``docs``.

    ``n`` is the number of code points of the whole text.  Forms are ``psm``
    (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) and ``plain``, which
    leaves the text as it is and has null counts.  Null texts are empty ones, and
    empty texts and such that hold a mark are plain; a null key hashes as an empty
    one; rows of equal key and text come out equal; an empty table gives no rows;
    other columns are not read.  A text of any length is cut in memory of a few
    times its size.
    """
    marked = [m.encode() for m in _checked(marks)]
    importable(docs.sparkSession)
    texts = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    source = docs.select(docs[f"`{key}`"].alias("_k"), texts.alias("_t"), *_numbers(docs[f"`{key}`"], seed))
    schema = T.StructType([
        T.StructField("_k", docs.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("_output", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            numbers = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
            for at, rows in _slices(batch, column):
                made = cut(column.slice(at, rows), [x[at : at + rows] for x in numbers], marked, plain_percent, spm_percent)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                columns = [batch.column(0).slice(at, rows), *(pa.array(x, k) for x, k in zip(made, kinds))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    made = source.mapInArrow(run, schema)
    return made.select(
        F.col("_k").alias(key), "n", "form", "prefix_chars", "middle_chars", F.col("_output").cast("string").alias("output")
    )


def restore(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``output`` of a ``form`` was made from; null for an unknown form."""
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in _checked(marks)), -1)
    first, second, middle = (F.get(parts, i) for i in (1, 2, 3))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
    )
