"""Byte-pair encoding by backtracking over longest matches, in time linear in the text.

The vocabulary file gives the merges in order.  A word is its bytes, the last one
marked as the word's end; a token's id is also its rank.  Two tokens may stand
side by side only if merging their joined bytes from scratch leaves them as they
are: the pair-compatibility table, filled as pairs are met.  If all neighbours
are compatible, the whole sequence is what the merges would give.

To encode, an Aho-Corasick automaton gives the longest token at each place it is
asked for; a token that is incompatible with the one before it is replaced by its
next shorter prefix, and when none is left the token before is taken back, its end
being remembered as a dead end.  Words repeat, and so do the runs of words and
signs between two spaces, so a task keeps the ids of those it has met last.

To decode, ids index an offset table into one buffer of all tokens' bytes.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T
from tokenizers import Regex, Tokenizer, pre_tokenizers

from siltstone.llm.arrow import SLICE_ROWS, importable, with_texts

#: Words and runs that a task remembers before it forgets as many older ones; bounds memory, not results.
CACHE_WORDS = 300_000
#: Longer ones are encoded each time they occur.
CACHE_CHARS = 64
#: Symbols of a word in which the automaton goes on from token to token.
WINDOW = 64
#: Pairs in the compatibility table before it starts afresh.
TABLE_PAIRS = 200_000

WORD_END = "</w>"


def _printable_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in the file, by the byte-level convention."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of one vocabulary file with word ends.

    Inside, a word is a string of symbols: a byte, or 256 and a byte at the end.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path = path
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
            raise ValueError("the vocabulary must be byte pairs with word ends")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        byte = _printable_bytes()

        def symbols(token: str) -> str:
            end = token.endswith(WORD_END)
            codes = [byte[c] for c in (token.removesuffix(WORD_END) if end else token)]
            return "".join(map(chr, codes[:-1])) + chr(codes[-1] + 256 * end)

        #: Each token's symbols, none for special tokens.
        size = max([*ids.values(), *self.special.values()]) + 1
        self.symbols = [""] * size
        for text, i in ids.items():
            if text not in self.special:
                self.symbols[i] = symbols(text)
        #: The merge of two tokens; its rank, its two tokens, both kept by the merged id.
        self.merged: dict[tuple[int, int], int] = {}
        self.rank = [-1] * size
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, both = ids[left], ids[right], ids[left + right]
            self.merged[a, b] = both
            self.rank[both] = rank
            self.parts[both] = (a, b)
        self._compatible: dict[int, bool] = {}
        #: Tokens that merging their own bytes gives; no other can come out.
        stable = {i for i, s in enumerate(self.symbols) if s and i not in self.parts}
        for both, (a, b) in self.parts.items():
            if a in stable and b in stable and self._apart(a, b):
                stable.add(both)
        known = {self.symbols[i]: i for i in stable}
        if not all(chr(c) in known for c in range(512)):
            raise ValueError("the vocabulary must hold every byte, as a word's end too")
        self.automaton = ahocorasick.Automaton()
        for s, i in known.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.lengths = [len(s) for s in self.symbols]
        self.width = max(self.lengths)
        #: The longest token that is a proper prefix of each.
        self.shorter = [
            next((known[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in known), -1) for s in self.symbols
        ]

    def _apart(self, left: int, right: int) -> bool:
        """Whether both tokens arise from their joined bytes before anything merges across the border.

        The later made of the two is taken apart at the border, again and again;
        pieces that then meet would have merged first, had their merge a lower
        rank.  On equal ranks the merge further left comes first.
        """
        merged, rank, parts = self.merged, self.rank, self.parts
        while True:
            if rank[left] > rank[right]:
                limit = rank[left]
                left = parts[left][1]
            elif rank[right] >= 0:
                limit = rank[right] + 1
                right = parts[right][0]
            else:
                return True
            both = merged.get((left, right))
            if both is not None and rank[both] < limit:
                return False

    def may_meet(self, left: int, right: int) -> bool:
        """The pair-compatibility table: whether merging the bytes of both tokens leaves just these two."""
        table, pair = self._compatible, left << 32 | right
        known = table.get(pair)
        if known is None:
            if len(table) >= TABLE_PAIRS:
                table.clear()
            known = table[pair] = (left, right) not in self.merged and self._apart(left, right)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one word."""
        text = word[:-1].decode("latin-1") + chr(word[-1] + 256)
        count, width = len(text), self.width
        longest, lengths, shorter = self.automaton.iter_long, self.lengths, self.shorter
        table, may_meet = self._compatible, self.may_meet
        dead: set[int] = set()
        found: list[int] = []
        at, last = 0, -1
        while True:
            # The automaton copies what it is given: a window whose tokens begin before ``sure`` and end within it.
            sure = count if at + WINDOW + width >= count else at + WINDOW
            for _, offer in longest(text[at : sure + width]):
                if at >= sure:
                    break
                if last >= 0:
                    fits = table.get(last << 32 | offer)
                    if not (may_meet(last, offer) if fits is None else fits):
                        break
                end = at + lengths[offer]
                if end in dead:
                    break
                found.append(offer)
                at, last = end, offer
            else:
                return found
            if at >= sure:
                continue
            offer = shorter[offer]
            while offer < 0 or at + lengths[offer] in dead or (last >= 0 and not may_meet(last, offer)):
                if offer < 0:
                    # No token fits here: the one before must end elsewhere.
                    dead.add(at)
                    offer = found.pop()
                    at -= lengths[offer]
                    last = found[-1] if found else -1
                offer = shorter[offer]
            found.append(offer)
            at, last = at + lengths[offer], offer


def normalize(text: str) -> str:
    """Composed and in lower case, letter by letter (a final sigma is not special)."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()


@lru_cache(maxsize=1)
def _newer() -> np.ndarray:
    """Marks the letters and numbers that Python's own tables do not know yet; libraries differ on them."""
    unknown = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    found = "".join(regex.findall(r"[\p{L}\p{N}\s]", unknown))
    marks = np.zeros(0x110000, bool)
    marks[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = True
    return marks


class Recent(dict):
    """What ``make`` gives for each key, made again only for keys not met lately."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        made = self.older.get(key)
        return self.keep(key, self.make(key) if made is None else made)

    def keep(self, key: str, made: bytes) -> bytes:
        if len(key) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.older = dict(self)
                self.clear()
            self[key] = made
        return made


class Encoder:
    """Whole texts to ids, packed as 32-bit numbers; remembers those of the words and runs it has met last."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._pattern = regex.compile(vocabulary.pattern)
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")")
        self._recent = Recent(self._run)
        self._library: Tokenizer | None = None

    def _library_words(self, text: str) -> list[str]:
        """Words of a text, normalised and cut by the library whose file this is."""
        if self._library is None:
            self._library = Tokenizer.from_file(self.vocabulary.path)
        cut = pre_tokenizers.Split(Regex(self.vocabulary.pattern), "removed", invert=True)
        return [piece for piece, _ in cut.pre_tokenize_str(self._library.normalizer.normalize_str(text))]

    def _word(self, word: str) -> bytes:
        return array("i", self.vocabulary.encode_word(word.encode())).tobytes()

    def _run(self, run: str) -> bytes:
        """Ids of what stands between two spaces; a word cut out of it gives itself when cut again."""
        words = [run] if run.isascii() and run.isalpha() else self._pattern.findall(run)
        return self._word(run) if words == [run] else b"".join(map(self._recent.__getitem__, words))

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A text with letters newer than Python's tables is normalised and cut by
        the library, so that both agree on what a letter is.  No word holds a
        space, so others are cut at spaces first, and then each new run.
        """
        recent = self._recent
        if not text.isascii() and _newer()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            words = self._library_words(text)
            return b"".join([recent[w] if w in recent else recent.keep(w, self._word(w)) for w in words])
        spaced = normalize(text).replace("\n", " ").replace("\r", " ").replace("\t", " ")
        return b"".join(map(recent.__getitem__, spaced.split(" ")))

    def pack(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        special = self.vocabulary.special
        parts = self._special.split(text) if special else [text]
        if len(parts) == 1:
            return self._plain(text)
        return b"".join(array("i", [special[p]]).tobytes() if p in special else self._plain(p) for p in parts)

    def encode(self, text: str) -> list[int]:
        return array("i", self.pack(text)).tolist()

    def lists(self, texts: Sequence[bytes | None]) -> pa.ListArray:
        """The ids of each text; null texts have none."""
        packed = [self.pack((t or b"").decode()) for t in texts]
        return pa.ListArray.from_arrays(offsets([len(p) // 4 for p in packed]), np.frombuffer(b"".join(packed), np.int32))


def offsets(counts: Sequence[int]) -> np.ndarray:
    """Where lists of so many items begin, and where the last one ends."""
    return np.cumsum(np.concatenate([[0], counts]), dtype=np.int64)


class OffsetTable:
    """All tokens' text in one buffer and where each begins."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        spelt = [""] * (max(ids.values()) + 1)
        for text, i in ids.items():
            spelt[i] = text
        self.tokens = pa.array(spelt, pa.string())

    def decode(self, lists: pa.ListArray) -> pa.StringArray:
        """The text of each list's tokens, gathered at once and joined by spaces; nothing for no ids."""
        ids = lists.flatten()
        if ids.null_count:
            raise ValueError("an id must not be null")
        counts = pc.list_value_length(lists).fill_null(0).to_numpy()
        return pc.binary_join(pa.ListArray.from_arrays(offsets(counts), self.tokens.take(ids)), " ")


@lru_cache(maxsize=2)
def offset_table(path: str) -> OffsetTable:
    return OffsetTable(path)


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """The tables of a file, made once in each worker."""
    return Vocabulary(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", path: str | None = None, ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and the token ids of each row's whole text.

    Null, empty and blank texts have no ids.  Special tokens spelt out in a text
    are recognised, as the vocabulary file asks.  Every row is encoded on its own,
    repeated ones too; other columns are not read.
    """
    path = path or default_path()

    def make():
        lists = Encoder(load(path)).lists
        return lambda texts: [lists(texts)]

    return with_texts(docs, keep, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make)


def round_trip(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", path: str | None = None, ids: str = "ids",
    decoded: str = "decoded",
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: columns ``keep``, the ids of each row and the text they decode to."""
    path = path or default_path()

    def make():
        lists, table = Encoder(load(path)).lists, offset_table(path)

        def step(texts: list[bytes | None]) -> list[pa.Array]:
            found = lists(texts)
            return [found, table.decode(found)]

        return step

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]
    return with_texts(docs, keep, text, fields, make)


def decode(encoded: DataFrame, keep: Sequence[str] = ("doc_id",), ids: str = "ids", path: str | None = None, text: str = "decoded") -> DataFrame:
    """Columns ``keep`` and the text of each row's ids, as the vocabulary file decodes: tokens joined by spaces.

    The file names no decoder, so word ends stay as they are spelt.  Null and empty lists give an empty text.
    """
    path = path or default_path()
    importable(encoded.sparkSession)
    source = encoded.select(*keep, ids)
    schema = T.StructType([*(source.schema[c] for c in keep), T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = offset_table(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                decoded = table.decode(piece.column(len(keep)))
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(keep)], decoded], names=schema.names)

    return source.mapInArrow(run, schema)
