"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0 < 1 < ... < K - 1. One weight vector over hashed text features is shared by all
grades; K - 1 ordered thresholds cut its score: P(grade >= k) = sigmoid(w.x - t_k). A
text's expected grade is the sum of these tail probabilities, and a text is selected when
the tail probability of ``select_grade`` is ``min_tail`` or more.

Features of a word are hashed from its lower-cased form, its shape (runs of capitals,
small letters, digits, other signs) and its last three characters; they count by their
share of the text's words. All pieces of three characters of a word of over ``LONG``
(a line without spaces, say) share one more such count. The text's length and its share of distinct words are hashed
features too. Labels are never features.

The fit uses a bounded, deterministic sample: the ``max_labelled`` rated ids that come
first by hash. Features are hashed where texts are read; one task fits them with
minibatch AdaGrad. The model has ``2 ** BITS`` weights whatever the corpus, so it can be
sent to every task. All rows are scored in one narrow pass over whole texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import texts

BITS = 18
#: Rated ids that the fit reads at most.
MAX_LABELLED = 6000
#: Words whose score a worker remembers.
REMEMBERED = 300_000
#: Characters of a word from which on its pieces are features too.
LONG = 64
_SHAPE = re.compile(r"([^\W\d_]+)|(\d+)|([\W_]+)")
_REPEATED = re.compile(r"(.{1,4}?)\1{2,}", re.DOTALL)


def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def _shape(word: str) -> str:
    """The marks of the whole word's runs; over eight marks, what repeats counts as if it came twice."""
    def kind(m: re.Match) -> str:
        if m[1]:
            return "A" if m[1].isupper() else "T" if m[1][:1].isupper() else "a"
        return "9" if m[2] else _REPEATED.sub(r"\1\1", m[3])

    marks = "".join(kind(m) for m in _SHAPE.finditer(word))
    return _REPEATED.sub(r"\1\1", marks) if len(marks) > 8 else marks


def word_values(word: str) -> list[tuple[int, float]]:
    """Slots of a word's features and their values."""
    low = word.lower()
    out = [(_slot("w " + low), 1.0), (_slot("s " + _shape(word)), 1.0), (_slot("e " + low[-3:]), 1.0)]
    if len(low) > LONG:
        pieces = Counter(low[i:i + 3] for i in range(len(low) - 2))
        out += [(_slot("p " + p), n / (len(low) - 2)) for p, n in pieces.items()]
    return out


def text_slots(n_words: int, n_distinct: int) -> tuple[int, int]:
    """Features of the whole text: its length in powers of two, its tenths of distinct words."""
    return _slot(f"n {n_words.bit_length()}"), _slot(f"d {10 * n_distinct // max(n_words, 1)}")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text, slots ascending and distinct."""
    found = text.split()
    values: dict[int, float] = {}
    counts = Counter(found)
    for word, n in counts.items():
        for slot, value in word_values(word):
            values[slot] = values.get(slot, 0.0) + value * n / len(found)
    for slot in text_slots(len(found), len(counts)):
        values[slot] = values.get(slot, 0.0) + 1.0
    slots = np.array(sorted(values), dtype=np.int32)
    return slots, np.array([values[s] for s in slots.tolist()], dtype=np.float32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, 2 ** BITS
    thresholds: np.ndarray  # float64, ascending

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, a column each."""
        return 1.0 / (1.0 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -50, 50)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, epochs: int = 12, batch: int = 128,
        rate: float = 0.5, decay: float = 1e-5) -> Model:
    """Maximum likelihood of (grade, slots, values) rows; the same rows give the same model."""
    size = 1 << BITS
    w, gw = np.zeros(size), np.full(size, 1e-6)
    # The first threshold and the logarithms of the steps between thresholds keep them ordered.
    t, gt = np.zeros(grades - 1), np.full(grades - 1, 1e-6)
    order = np.random.default_rng(0)

    def thresholds() -> np.ndarray:
        return t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])

    y = np.array([g for g, _, _ in rows], dtype=np.int64)
    for _ in range(epochs if rows else 0):
        shuffled = order.permutation(len(rows))
        for at in range(0, len(rows), batch):
            pick = shuffled[at:at + batch]
            slots = np.concatenate([rows[i][1] for i in pick])
            values = np.concatenate([rows[i][2] for i in pick]).astype(np.float64)
            sizes = np.array([len(rows[i][1]) for i in pick])
            owner = np.repeat(np.arange(len(pick)), sizes)
            score = np.bincount(owner, w[slots] * values, minlength=len(pick))
            tail = 1.0 / (1.0 + np.exp(-np.clip(score[:, None] - thresholds()[None, :], -30, 30)))
            s = np.concatenate([np.ones((len(pick), 1)), tail, np.zeros((len(pick), 1))], axis=1)
            lower, upper = s[np.arange(len(pick)), y[pick]], s[np.arange(len(pick)), y[pick] + 1]
            p = np.maximum(lower - upper, 1e-9)
            d_score = (1.0 - lower - upper) / len(pick)
            d_t = np.zeros((len(pick), grades + 1))
            d_t[np.arange(len(pick)), y[pick]] -= lower * (1 - lower) / p
            d_t[np.arange(len(pick)), y[pick] + 1] += upper * (1 - upper) / p
            d_theta = d_t[:, 1:grades].mean(axis=0)
            d_step = np.concatenate([[d_theta.sum()], np.cumsum(d_theta[::-1])[::-1][1:] * np.exp(t[1:])])
            g = np.bincount(slots, values * d_score[owner], minlength=size) - decay * w
            gw += g * g
            w += rate * g / np.sqrt(gw)
            gt += d_step * d_step
            t += 0.1 * d_step / np.sqrt(gt)
    return Model(w.astype(np.float32), thresholds())


def _sample(docs: DataFrame, ratings: DataFrame, max_labelled: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, grade of the sampled ids, one row per id."""
    rated = (ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # At most max_labelled rows of 12 bytes.
    rows = texts(docs, id_col, text_col).join(F.broadcast(rated), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("grade").alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, grades: int, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """The model of ``ratings`` (doc_id, grade). Several ratings of an id: the lowest holds.

    No ratings: zero weights and thresholds that select everything.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("grade"), pa.array([s.tobytes() for s, _ in x], pa.binary()),
                 pa.array([v.tobytes() for _, v in x], pa.binary())], ["doc_id", "grade", "slots", "vals"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(d, g, np.frombuffer(s, np.int32), np.frombuffer(v, np.float32)) for b in batches
                for d, g, s, v in zip(*(b.column(n).to_pylist() for n in ("doc_id", "grade", "slots", "vals")), strict=True)]
        rows.sort(key=lambda r: r[0])
        model = fit([r[1:] for r in rows], grades)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()),
                                          pa.array([model.thresholds.tolist()], pa.list_(pa.float64()))],
                                         ["weights", "thresholds"])

    sample = _sample(docs, ratings, max_labelled, id_col, text_col)
    one = (sample.mapInArrow(hashed, "doc_id long, grade int, slots binary, vals binary").repartition(1)
           .mapInArrow(fitted, "weights binary, thresholds array<double>").first())
    if one is None:
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(grades - 1))
    return Model(np.frombuffer(one["weights"], np.float32), np.array(one["thresholds"]))


class _Scores(dict):
    """Score of a word, looked up once; forgets everything when full."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[word] = math.fsum(v * float(self.weights[s]) for s, v in word_values(word))
        return out


def score(docs: DataFrame, model: Model, select_grade: int = 1, min_tail: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, expected_grade, tail_probability, kept.

    With ``carry`` also ``row``, the struct of all input columns. Null text counts as
    empty and is scored by its length alone; nulls and repeated rows stay as they are; an
    empty table gives an empty result.
    """
    rows = texts(docs, id_col, text_col, carry)
    out = "doc_id long, expected_grade double, tail_probability double, kept boolean"

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Scores(model.weights)
        for b in batches:
            total = np.empty(b.num_rows)
            for i, t in enumerate(b.column("text")):
                found = t.as_py().split()
                total[i] = sum(map(known.__getitem__, found)) / max(len(found), 1) + sum(
                    float(model.weights[s]) for s in text_slots(len(found), len(set(found))))
            tails = model.tails(total)
            tail = tails[:, select_grade - 1]
            cols = [b.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= min_tail)]
            names = ["doc_id", "expected_grade", "tail_probability", "kept"]
            yield pa.RecordBatch.from_arrays([*cols, b.column("row")] if carry else cols,
                                             [*names, "row"] if carry else names)

    if carry:
        out += f", row {rows.schema['row'].dataType.simpleString()}"
    return rows.mapInArrow(scored, out)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from the labels: 0 poor, 1 acceptable but toxic, 2 good."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1)
                         .when(F.col("quality") == 1, 2).cast("int").alias("grade"))
