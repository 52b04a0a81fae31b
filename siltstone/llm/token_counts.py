"""Token counts of a document's sections, from one encoding of the whole document.

Encoding sections apart would cut tokens that span a border.  Here a document is
encoded once, each token's span of characters is found from the byte lengths of
the tokens, and spans are joined to the sections' intervals.  A token that
crosses a border goes where the rule says: to the section that holds its first
character (``first``), its last (``last``), most of them with ties to the earlier
section (``most``), or to all in proportion (``share``).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, types as T

from siltstone.llm.arrow import SLICE_ROWS, importable, texts

RULES = ("first", "last", "most", "share")
SEPARATOR = "\n"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def load(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a file of ranks, made once in each worker, and each token's bytes."""
    import public_tokenizers

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding, lengths


def token_spans(text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end character of each token; a character split over tokens belongs to all of them."""
    encoding, lengths = load(path)
    ids = np.array(encoding.encode_ordinary(text), np.int64)
    stops = np.cumsum(lengths[ids])
    starts = stops - lengths[ids]
    if text.isascii():
        return starts, stops
    lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    character = np.cumsum(lead) - 1
    return character[starts], character[stops - 1] + 1


def section_starts(text: str, separator: str = SEPARATOR) -> np.ndarray:
    """Where sections begin; each keeps the separator that ends it, and a text has one at least."""
    sizes = np.array([len(piece) + len(separator) for piece in text.split(separator)], np.int64)
    starts = np.cumsum(sizes) - sizes
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(text) else starts


def allocate(starts: np.ndarray, stops: np.ndarray, sections: np.ndarray, end: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section by the rule, and how many tokens touch it and another."""
    count = len(sections)
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.searchsorted(sections, stops - 1, "right") - 1
    whole = first == last
    tokens = np.bincount(first[whole], minlength=count).astype(np.float64)
    crossing = np.zeros(count, np.int64)
    bounds = np.append(sections, end)
    for begin, stop, low, high in zip(starts[~whole], stops[~whole], first[~whole], last[~whole]):
        held = np.minimum(bounds[low + 1 : high + 2], stop) - np.maximum(bounds[low : high + 1], begin)
        crossing[low : high + 1] += held > 0
        if rule == "share":
            tokens[low : high + 1] += held / held.sum()
        else:
            tokens[low if rule == "first" else high if rule == "last" else low + held.argmax()] += 1
    return tokens, crossing


def count_sections(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rule: str = "most", separator: str = SEPARATOR, path: str | None = None
) -> DataFrame:
    """Rows (key, section, start, stop, n_tokens, n_crossing) for every section of every row's whole text.

    Sections are numbered from 0; offsets are characters, the end exclusive, and
    a section keeps its separator.  The tokens of a document's sections add up to
    the tokens of the document.  Null and empty texts have one empty section;
    repeated rows are counted one by one; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"the rule must be one of {RULES}")
    path = path or default_path()
    importable(docs.sparkSession)
    source = docs.select(docs[f"`{key}`"].alias(key), docs[f"`{text}`"].cast("string").alias("_body"))
    longs = ("section", "start", "stop")
    schema = T.StructType([
        source.schema[key], *(T.StructField(c, T.LongType()) for c in longs),
        T.StructField("n_tokens", T.DoubleType()), T.StructField("n_crossing", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                sizes, parts = [], []
                for body in texts(piece.column(1)):
                    decoded = (body or b"").decode()
                    sections = section_starts(decoded, separator)
                    tokens, crossing = allocate(*token_spans(decoded, path), sections, len(decoded), rule)
                    sizes.append(len(sections))
                    parts.append((np.arange(len(sections)), sections, np.append(sections[1:], len(decoded)), tokens, crossing))
                columns = [np.concatenate(c) for c in zip(*parts)]
                keys = piece.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, columns)], names=schema.names)

    return source.mapInArrow(run, schema)
