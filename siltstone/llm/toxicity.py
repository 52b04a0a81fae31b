"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

A sentence is compared through its units: words, and runs of single letters
joined, so that spaced-out letters are read as a word.  The kernel of two units
counts the subsequences of four letters they share, gaps of up to two letters
allowed, each occurrence weighing ``DECAY`` to the power of its length; so an
insult with a letter put in or a new ending stays close to what was learnt.

Units of labelled sentences train the machine, a sentence having the label of
its text.  Which words are the insults is not labelled: units that occur in
distinct toxic sentences far more often than chance allows stand for insulting
sentences, units of clean ones for clean sentences.
Landmarks taken from both span the features (Nyström); the trained machine is
then a single weight for each subsequence, so scoring a unit is a table look-up.
The hardest clean units found by a first machine train a second one.

A text's units are a bag: its two greatest margins, the number of its units on
the machine's wrong side and its length go into a logistic curve, fitted to
labelled texts, that gives the probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from siltstone.llm.arrow import SLICE_ROWS, importable, texts, with_texts
from siltstone.llm.langid import bounded, letter_classes
from siltstone.session import materialise

ORDER, REACH, DECAY = 4, 6, 0.6

#: Bounds of what the machine is fitted on: labelled texts of each class, units, landmarks.
TRAIN_ROWS = 3000
INSULT_UNITS = 400
CLEAN_UNITS = 6000
HARD_UNITS = 2000
LANDMARKS = 160

#: Evidence (G statistic) that ties a unit to toxic texts where none has as much as chance may give.
LEAST_EVIDENCE = 8.0

PREDICTED_FROM = 0.7

#: Units are cut into overlapping pieces of this many letters, in fitting as in scoring.
PIECE, OVERLAP, CUT = 48, 8, "-"
#: Tokens that a task remembers before it starts afresh; bounds memory, not results.
CACHE_TOKENS = 400_000

_BEGIN, _END = 62, 63
# Stand before and after a piece while many are coded at once; no unit has such characters.
_FROM, _TO = "\x01", "\x02"
_SENTENCE_END = re.compile(rb"(?<=[.!?])\s+|\n")
_SPACED = re.compile(r"(?<!\S)(?:\w\W*\s){2,}\w\W*(?!\S)")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Letter classes below the two that mark the ends of a unit, and these at the characters that stand for them."""
    table = letter_classes().copy()
    table[table >= _BEGIN] -= 8
    table[48:58] = 54
    table[[ord(_FROM), ord(_TO)]] = _BEGIN, _END
    return table


def tokens(text: bytes | None) -> set[str]:
    """The distinct tokens of a whole text, runs of three or more single letters being one more token each."""
    decoded = (text or b"").decode()
    return {*decoded.split(), *("".join(m.group().split()) for m in _SPACED.finditer(decoded))}


def unit(token: str) -> str:
    """Letters and digits of a token in lower case."""
    return "".join(filter(str.isalnum, token.lower()))


def pieces(word: str) -> list[str]:
    """Overlapping pieces of a unit; ``CUT`` stands where a piece does not begin or end with its unit."""
    if len(word) <= PIECE:
        return [word]
    return [
        CUT * (at > 0) + word[at : at + PIECE] + CUT * (at + PIECE < len(word))
        for at in range(0, max(len(word) - OVERLAP, 1), PIECE - OVERLAP)
    ]


def _coded(parts: Sequence[str]) -> np.ndarray:
    """Pieces as rows of classes between end marks, -1 filling the rows."""
    joined = f"{_TO}{_FROM}".join(parts).join((_FROM, _TO)).replace(_FROM + CUT, "").replace(CUT + _TO, "") if parts else ""
    codes = _classes()[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
    cuts = np.fromiter(((p[:1] == CUT) + (p[-1:] == CUT) for p in parts), np.int64, len(parts))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 2 - 2 * cuts
    rows = np.full((len(parts), max(map(len, parts), default=0) + 2), -1, np.int32)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = codes
    return rows


_OFFSETS = np.array([(0, *rest) for rest in combinations(range(1, REACH), ORDER - 1)])
_WEIGHTS = (DECAY ** (_OFFSETS[:, -1] + 1)).astype(np.float32)


def subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (row, occurrence) of all subsequences, and their weights (zero where a row has ended)."""
    padded = np.pad(rows, ((0, 0), (0, REACH)), constant_values=-1)
    starts = np.arange(rows.shape[1])
    taken = padded[:, starts[:, None, None] + _OFFSETS[None]]
    there = (taken >= 0).all(axis=3)
    code = np.zeros(there.shape, np.int32)
    for k in range(ORDER):
        code = code << 6 | np.where(there, taken[..., k], 0)
    weight = np.where(there, _WEIGHTS[None, None], 0).astype(np.float32)
    return code.reshape(len(rows), -1), weight.reshape(len(rows), -1)


def _norms(weight: np.ndarray) -> np.ndarray:
    return np.maximum(np.sqrt((weight.astype(np.float64) ** 2).sum(1)), 1e-9)


def margins(units: Sequence[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin of each unit: the greatest of its pieces'."""
    out = np.full(len(units), -np.inf)
    # Pieces of about one length share an array, so that a long one does not widen all.
    cut = list(map(pieces, units))
    parts = list(chain.from_iterable(cut))
    owners = np.repeat(np.arange(len(units)), np.fromiter(map(len, cut), np.int64, len(cut)))
    order = np.argsort(np.fromiter(map(len, parts), np.int64, len(parts)), kind="stable")
    for at in range(0, len(parts), 2048):
        some = order[at : at + 2048]
        code, weight = subsequences(_coded([parts[i] for i in some]))
        found = (table[code] * weight).sum(1, dtype=np.float64) / _norms(weight) + bias
        np.maximum.at(out, owners[some], found)
    return out


def kernel(units: Sequence[str], landmarks: Sequence[str]) -> np.ndarray:
    """Kernel values (piece, landmark)."""
    marks, mark_weight = subsequences(_coded(landmarks))
    mark_weight = mark_weight / _norms(mark_weight)[:, None]
    out = np.zeros((len(units), len(landmarks)))
    dense = np.zeros(1 << 6 * ORDER, np.float32)
    code, weight = subsequences(_coded(units))
    weight = weight / _norms(weight)[:, None]
    for m in range(len(landmarks)):
        np.add.at(dense, marks[m], mark_weight[m])
        out[:, m] = (dense[code] * weight).sum(1)
        dense[marks[m]] = 0
    return out


@dataclass(frozen=True)
class Machine:
    """Landmarks with their weights, the bias, and the logistic curve over a text's ``FEATURES``."""

    landmarks: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    slopes: tuple[float, ...] = ()
    shift: float = 0.0

    def table(self) -> np.ndarray:
        """The weight of each subsequence: all the machine knows, folded together."""
        out = np.zeros(1 << 6 * ORDER, np.float32)
        if self.landmarks:
            code, weight = subsequences(_coded(self.landmarks))
            share = weight / _norms(weight)[:, None] * np.array(self.weights)[:, None]
            np.add.at(out, code.ravel(), share.ravel().astype(np.float32))
        return out


def landmarks(units: Sequence[str], most: int) -> list[str]:
    """Units that span the others best: each next one is what those before explain least (pivoted Cholesky)."""
    units = list(dict.fromkeys(units))
    gram = kernel(units, units)
    left = np.diag(gram).copy()
    columns = np.zeros((len(units), 0))
    chosen: list[int] = []
    while len(chosen) < min(most, len(units)) and left.max() > 1e-6:
        i = int(left.argmax())
        column = (gram[:, i] - columns @ columns[i]) / np.sqrt(left[i])
        columns = np.hstack([columns, column[:, None]])
        left = np.maximum(left - column**2, 0)
        left[i] = 0
        chosen.append(i)
    return [units[i] for i in chosen]


def fit_machine(insults: Sequence[str], clean: Sequence[str], insult_weight: np.ndarray, penalty: float = 1e-3) -> Machine:
    """A linear support vector machine (squared hinge) on Nyström features of units."""
    half = LANDMARKS // 2
    marks = list(dict.fromkeys([*landmarks(insults, half), *landmarks(clean[: 4 * half], half)]))
    values, basis = np.linalg.eigh(kernel(marks, marks))
    whiten = basis / np.sqrt(np.maximum(values, 1e-6))
    x = np.hstack([kernel([*insults, *clean], marks) @ whiten, np.ones((len(insults) + len(clean), 1))])
    y = np.concatenate([np.ones(len(insults)), -np.ones(len(clean))])
    weight = np.concatenate([insult_weight / insult_weight.sum(), np.full(len(clean), 1 / max(len(clean), 1))])
    ridge = np.eye(x.shape[1]) * penalty
    ridge[-1, -1] = 1e-9
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps on the rows inside the margin
        inside = y * (x @ w) < 1
        a = x[inside] * weight[inside, None]
        step = np.linalg.solve(ridge + a.T @ x[inside], a.T @ y[inside])
        if np.allclose(step, w, atol=1e-9):
            break
        w = step
    return Machine(tuple(marks), tuple((whiten @ w[:-1]).tolist()), float(w[-1]))


def fit_curve(x: np.ndarray, label: np.ndarray, penalty: float = 1e-4) -> tuple[tuple[float, ...], float]:
    """Slopes and shift of a logistic curve over standardised columns, by Newton steps."""
    middle, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.hstack([(x - middle) / spread, np.ones((len(x), 1))])
    ridge = np.eye(z.shape[1]) * penalty * len(x)
    ridge[-1, -1] = 1e-9
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (label - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[:-1] / spread
    return tuple(slopes.tolist()), float(w[-1] - slopes @ middle)


def _sentence_units(labelled: DataFrame) -> DataFrame:
    """(toxic, sentence, unit): the pieces of each sentence's units in labelled texts, the sentence as a hash."""
    importable(labelled.sparkSession)
    schema = T.StructType([
        T.StructField("toxic", T.IntegerType()), T.StructField("sentence", T.LongType()), T.StructField("unit", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                marks, hashes, units = [], [], []
                for mark, text in zip(piece.column(0).to_pylist(), texts(piece.column(1))):
                    for sentence in _SENTENCE_END.split(text or b""):
                        found = {p for t in tokens(sentence) for p in pieces(unit(t))} - {""}
                        marks += [mark] * len(found)
                        hashes += [xxhash.xxh64_intdigest(sentence.lower()) - (1 << 63)] * len(found)
                        units += found
                columns = [pa.array(marks, pa.int32()), pa.array(hashes, pa.int64()), pa.array(units, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return labelled.select("toxic", "text").mapInArrow(run, schema)


class _Scorer:
    """``FEATURES`` of whole texts; remembers the tokens it has met."""

    def __init__(self, machine: Machine):
        self._table, self._bias = machine.table(), machine.bias
        self._known: dict[str, float] = {}

    def __call__(self, batch: Sequence[bytes | None]) -> list[Sequence]:
        known = self._known
        if len(known) > CACHE_TOKENS:
            known.clear()
        found = [tokens(t) for t in batch]
        new = [t for t in set().union(*found) if t not in known]
        units = [unit(t) for t in new]
        known.update(zip(new, margins(units, self._table, self._bias).tolist()))
        out = np.zeros((len(batch), len(FEATURES)))
        for row, words in zip(out, found):
            margin = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
            top = np.sort(np.concatenate([np.partition(margin, -2)[-2:] if len(margin) > 2 else margin, [LOWEST, LOWEST]]))[::-1]
            row[:] = (max(top[0], LOWEST), max(top[1], LOWEST), np.log1p((margin > 0).sum()), np.log1p(len(words)))
        return list(out.T)


#: What a text is judged by: its greatest and second greatest margin, how many units lie beyond zero, its length.
FEATURES = ("first", "second", "beyond", "size")
LOWEST = -3.0


def text_features(docs: DataFrame, machine: Machine, keep: Sequence[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and the ``FEATURES`` of the whole text over its distinct tokens."""
    return with_texts(docs, keep, text, [T.StructField(f, T.DoubleType()) for f in FEATURES], lambda: _Scorer(machine))


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = TRAIN_ROWS
) -> Machine:
    """A machine from at most ``most`` labelled texts of each class.

    Rows without key or label teach nothing; a key with several labels counts as
    toxic if one says so.  Without a unit tied to toxic texts the machine scores
    all texts alike, by the share of toxic labels.
    """
    marked = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("toxic")).groupBy("key").agg(
        F.max("toxic").alias("toxic")
    )
    picked = materialise(bounded(marked, "key", "toxic", most), "picked")
    sample = docs.select(docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].cast("string").alias("text"))
    sample = materialise(sample.join(picked, "key").select("toxic", "text"), "sample")
    rows = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = rows.get(1, 0), rows.get(0, 0)
    flat = Machine((), (), 0.0, (0.0,) * len(FEATURES), float(np.log((toxic + 1) / (clean + 1)) - 1.0))
    if not toxic or not clean:
        return flat

    # A sentence counts once however many copies of it there are, and as clean if one text with it is.
    sentences = _sentence_units(sample).groupBy("unit", "sentence").agg(F.min("toxic").alias("toxic"))
    by_unit = materialise(sentences.groupBy("unit").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    ), "units")
    toxic, clean, units = by_unit.agg(F.sum("toxic"), F.sum("clean"), F.count("*")).first()
    if not toxic or not clean:
        return flat
    seen = F.col("toxic") + F.col("clean")

    def part(found: str, of: int):
        expected = seen * F.lit(of / (toxic + clean))
        return F.when(F.col(found) > 0, F.col(found) * F.log(F.col(found) / expected)).otherwise(0.0)

    tied = by_unit.withColumn("evidence", 2 * (part("toxic", toxic) + part("clean", clean))).where(
        F.col("toxic") * clean > 4 * F.col("clean") * toxic
    )
    # Chance ties about one of all units as much as twice the logarithm of their number.
    for least in (2 * np.log(units), LEAST_EVIDENCE):
        insults = tied.where(F.col("evidence") >= float(least)).orderBy(F.desc("evidence"), "unit").limit(INSULT_UNITS).collect()
        if insults:
            break
    else:
        return flat
    words = [r["unit"] for r in insults]
    weight = np.array([float(r["toxic"]) for r in insults])
    plain = by_unit.where("clean > 0").join(F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in words], "unit string")), "unit", "left_anti")
    common = [r["unit"] for r in plain.orderBy(F.desc("clean"), "unit").limit(CLEAN_UNITS // 2).collect()]
    others = [r["unit"] for r in plain.orderBy(F.xxhash64("unit"), "unit").limit(CLEAN_UNITS // 2).collect()]
    ordinary = list(dict.fromkeys([*common, *others]))

    first = fit_machine(words, ordinary, weight)
    scored = text_features(plain, first, ["unit"], "unit")
    hard = [r["unit"] for r in scored.orderBy(F.desc("first"), "unit").limit(HARD_UNITS).collect()]
    machine = fit_machine(words, [*ordinary, *hard], weight)
    judged = text_features(sample, machine, ["toxic"]).collect()
    slopes, shift = fit_curve(np.array([r[1:] for r in judged], float), np.array([float(r["toxic"]) for r in judged]))
    return Machine(machine.landmarks, machine.weights, machine.bias, slopes, shift)


def score(docs: DataFrame, machine: Machine, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep``, ``score`` (0 to 1) and ``predicted`` for every row's whole text.

    Null, empty and blank texts have no unit and the least margins.  Every row is
    scored on its own, repeated ones too; other columns are not read.
    """
    found = text_features(docs, machine, keep, text)
    logit = F.lit(machine.shift)
    for name, slope in zip(FEATURES, machine.slopes):
        logit = logit + F.lit(slope) * F.col(name)
    scored = found.withColumn("score", 1 / (1 + F.exp(-logit))).drop(*FEATURES)
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED_FROM).cast("int"))
