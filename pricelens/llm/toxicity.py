"""Toxicity: a linear-chain conditional random field tags toxic spans.

Token labels. Labels name toxic documents; the tokens of a toxic document that carry
them are those with a feature (word or prefix) that is frequent in toxic documents, in
differing places, and practically absent from the others. All other tokens are labelled clean.

Field. Two states. A token's score for the toxic state is the sum of hashed weights of
its own features (word, prefixes, suffix, shape); four transition weights join neighbours. Weights maximise the conditional likelihood, whose
gradient is the difference of observed and forward-backward expected features.

Document score. Forward-backward marginals of every token of the whole text give the
expected number of toxic tokens and the largest marginal; a logistic calibration, fitted
on labelled documents that the field was not fitted on, turns them into a score. Tokens
with a marginal of one half or more are the offending spans, with code-point offsets.

The fit uses a bounded, deterministic sample of the labelled documents (``MAX_TOXIC``,
``MAX_CLEAN``, ``TOKENS_EACH``) in one task; scoring is one narrow pass over all rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import texts

BITS = 18
#: Labelled documents that the fit reads at most, and tokens of each: a longer one gives as many in ``PIECES`` runs.
MAX_TOXIC, MAX_CLEAN, TOKENS_EACH = 1000, 2000, 1000
PIECES = 4
#: Words whose scores a worker remembers.
REMEMBERED = 300_000
#: Tokens of a chain in the fit, and tokens that are scored at a time (more only for one long text).
CHAIN, AT_ONCE = 256, 1_000_000
_TOKEN = re.compile(r"\w+")


def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def lexical(token: str) -> list[str]:
    """The word and prefixes by which token labels are derived and features hashed."""
    low = token.lower()
    return ["w " + low, *(f"p{k} " + low[:k] for k in (4, 5, 6) if len(low) > k)]


def own_slots(token: str) -> list[int]:
    shape = "A" if token.isupper() else "T" if token[:1].isupper() else "9" if token.isdigit() else "a"
    return [_slot(f) for f in (*lexical(token), "e " + token.lower()[-3:], "s " + shape, "bias")]


@dataclass(frozen=True)
class Field:
    weights: np.ndarray  # float32, 2 ** BITS
    moves: np.ndarray  # 2 x 2 transition weights, from row to column
    calibration: np.ndarray  # of 1, log-odds of the largest marginal, log expected tokens


def messages(unary: np.ndarray, starts: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages of every token of several texts, all texts one step at a time.

    ``unary`` holds the texts' token scores one after the other. Messages are kept as odds
    of the toxic state, so no product over a text underflows.
    """
    some = sizes > 0
    starts, sizes = starts[some], sizes[some]
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    (a00, a01), (a10, a11) = np.exp(moves)
    e = np.exp(np.clip(unary, -30, 30))
    forward, backward = np.ones(len(unary)), np.ones(len(unary))
    most = int(sizes[0]) if len(sizes) else 0
    longer = np.searchsorted(-sizes, -np.arange(1, most + 1), side="right")  # texts of t + 1 tokens or more
    for t in range(most):
        at = starts[:longer[t]] + t
        odds = e[at] if t == 0 else e[at] * (a01 + a11 * odds[:longer[t]]) / (a00 + a10 * odds[:longer[t]])
        forward[at] = odds
    odds = np.ones(len(sizes))
    for t in range(1, most):
        at = (starts + sizes)[:longer[t]] - 1 - t
        after = e[at + 1] * odds[:longer[t]]
        odds = (a10 + a11 * after) / (a00 + a01 * after)
        backward[at] = odds
    return forward, backward


def marginals(unary: np.ndarray, starts: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(toxic) of every token."""
    forward, backward = messages(unary, starts, sizes, moves)
    both = forward * backward
    return both / (1.0 + both)


def token_labels(tokens: list[list[str]], toxic: list[int]) -> list[np.ndarray]:
    """0/1 for every token: 1 in toxic documents, where a feature tells toxic documents apart."""
    n_toxic, n_clean = sum(toxic), len(toxic) - sum(toxic)
    seen = (Counter(), Counter())
    for found, y in zip(tokens, toxic, strict=True):
        seen[y].update({f for w in set(found) for f in lexical(w)})
    least = max(3, 0.015 * n_toxic)
    telling = {f for f, n in seen[1].items() if n >= least and seen[0][f] * max(n_toxic, 1) <= 0.02 * n * max(n_clean, 1)}
    # Copies of a toxic document share its rare words, but always between the same neighbours.
    between: dict[str, set[tuple[str, str]]] = {f: set() for f in telling}
    for found, y in zip(tokens, toxic, strict=True):
        for before, w, after in zip(["", *found], found, [*found[1:], ""]) if y else ():
            for f in lexical(w):
                if f in telling:
                    between[f].add((before, after))
    telling = {f for f in telling if len(between[f]) >= least}
    known: dict[str, int] = {}

    def label(w: str) -> int:
        if w not in known:
            known[w] = int(any(f in telling for f in lexical(w)))
        return known[w]

    return [np.array([label(w) if y else 0 for w in found], dtype=np.float64) for found, y in zip(tokens, toxic, strict=True)]


def fit(documents: list[tuple[str, int]], steps: int = 300, rate: float = 1.0, decay: float = 1e-4) -> Field:
    """The field and its calibration from (text, toxic) documents.

    The likelihood is that of the documents cut into chains of ``CHAIN`` tokens.
    """
    size = 1 << BITS
    tokens = [_TOKEN.findall(t) for t, _ in documents]
    toxic = [int(y) for _, y in documents]
    if not documents or not any(toxic) or all(toxic):
        share = (sum(toxic) + 0.5) / (len(toxic) + 1) if documents else 0.1
        return Field(np.zeros(size, np.float32), np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    labels = token_labels(tokens, toxic)
    known: dict[str, int] = {}
    chains: list[np.ndarray] = []
    truth: list[np.ndarray] = []
    for i in range(len(documents)):
        if i % 3 == 0:  # every third document calibrates
            continue
        ids = np.fromiter((known.setdefault(w, len(known)) for w in tokens[i]), np.int64, len(tokens[i]))
        chains += [ids[k:k + CHAIN] for k in range(0, len(ids), CHAIN)]
        truth += [labels[i][k:k + CHAIN] for k in range(0, len(ids), CHAIN)]
    of = [own_slots(w) for w in known]  # a word's slots; its tokens share them
    slots = np.array([s for x in of for s in x], dtype=np.int64)
    owner = np.repeat(np.arange(len(of)), [len(x) for x in of])
    word = np.concatenate(chains) if chains else np.zeros(0, np.int64)
    y = np.concatenate(truth) if truth else np.zeros(0)
    sizes = np.array([len(c) for c in chains], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    inner = np.ones(len(y), bool)
    inner[starts] = False
    t = np.nonzero(inner)[0]
    seen = np.array([[np.sum((1 - y[t - 1]) * (1 - y[t])), np.sum((1 - y[t - 1]) * y[t])],
                     [np.sum(y[t - 1] * (1 - y[t])), np.sum(y[t - 1] * y[t])]])
    w, gw = np.zeros(size), np.full(size, 1e-8)
    moves, gm = np.zeros((2, 2)), np.full((2, 2), 1e-8)
    scale = max(float(y.sum()), 1.0)
    for _ in range(steps):
        unary = np.bincount(owner, w[slots], minlength=len(of))[word]
        forward, backward = messages(unary, starts, sizes, moves)
        p = forward * backward / (1.0 + forward * backward)
        # A pair (t - 1, t) weighs forward(t - 1) * move * score(t) * backward(t).
        (a00, a01), (a10, a11) = np.exp(moves)
        on, off = np.exp(np.clip(unary[t], -30, 30)) * backward[t], forward[t - 1]
        pair = np.array([[np.full(len(t), a00), a01 * on], [a10 * off, a11 * off * on]])
        expected = (pair / pair.sum(axis=(0, 1))).sum(axis=2)
        by_word = np.bincount(word, y - p, minlength=len(of))
        g = np.bincount(slots, by_word[owner], minlength=size) / scale - decay * w
        gw += g * g
        w += rate * g / np.sqrt(gw)
        g = (seen - expected) / scale - decay * moves
        gm += g * g
        moves += 0.1 * g / np.sqrt(gm)
    field = Field(w.astype(np.float32), moves, np.zeros(3))
    rest = range(0, len(documents), 3)
    calibration = _calibrated(field, [tokens[i] for i in rest], np.array([toxic[i] for i in rest], float))
    return Field(field.weights, moves, calibration)


def _evidence(p: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of 1, log-odds of the largest marginal, log of the expected toxic tokens; empty texts: the least."""
    out = np.zeros((len(sizes), 3))
    out[:, 0] = 1.0
    out[:, 1], out[:, 2] = -12.0, -6.0
    some = np.nonzero(sizes > 0)[0]
    if len(some):
        top = np.clip(np.maximum.reduceat(p, starts[some]), 1e-9, 1 - 1e-9)
        out[some, 1] = np.clip(np.log(top / (1 - top)), -12, 12)
        out[some, 2] = np.log(np.add.reduceat(p, starts[some]) + 0.0025)
    return out


def _calibrated(field: Field, tokens: list[list[str]], y: np.ndarray) -> np.ndarray:
    words = _Words(field.weights)
    scores, starts, sizes = _joined([words.of(found) for found in tokens])
    x = _evidence(marginals(scores, starts, sizes, field.moves), starts, sizes)
    spread = np.array([1.0, 4.0, 2.0])
    x = x / spread
    c = np.zeros(3)
    for _ in range(50):  # Newton steps of ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        g = x.T @ (y - p) - 0.1 * c
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        c = c + np.linalg.solve(h, g)
    return c / spread


class _Words(dict):
    """A word's score for the toxic state, computed once; forgets everything when full."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.tolist()

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[word] = sum(map(self.weights.__getitem__, own_slots(word)))
        return out

    def of(self, found: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.float64, len(found))


def _joined(scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in scores], dtype=np.int64)
    return (np.concatenate(scores) if scores else np.zeros(0)), np.cumsum(sizes) - sizes, sizes


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a row without an id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def pieces(text: str, doc_id: int, each: int = TOKENS_EACH) -> str:
    """A text of at most ``each`` tokens whole; of a longer one, a run from each of ``PIECES`` equal parts, at a place hashed
    from the id."""
    found = list(_TOKEN.finditer(text))
    if len(found) <= each:
        return text
    out, part, run = [], len(found) / PIECES, max(1, each // PIECES)
    for k in range(PIECES):
        first, room = int(k * part), max(1, int((k + 1) * part) - int(k * part) - run + 1)
        first += zlib.crc32(f"{doc_id}:{k}".encode()) % room
        out.append(text[found[first].start():found[min(first + run, len(found)) - 1].end()])
    return "\n".join(out)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, tokens_each: int = TOKENS_EACH) -> Field:
    """The field of ``labels`` (doc_id, toxic); an id labelled both ways counts as toxic.

    A document's tokens are bounded where it is read (``pieces``), so a long one displaces no other and the task
    that fits holds ``(max_toxic + max_clean) * tokens_each`` tokens at most."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic"))
    first = lambda y, n: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = first(1, max_toxic).unionAll(first(0, max_clean))
    # At most max_toxic + max_clean rows of 12 bytes.
    rows = texts(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [pieces(t.as_py(), d, tokens_each) for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), b.column(2)], b.schema.names)

    rows = rows.mapInArrow(cut, "doc_id long, text string, toxic int")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(((zlib.crc32(str(d).encode()), d, t, y) for b in batches for d, t, y in
                        zip(*(b.column(n).to_pylist() for n in ("doc_id", "text", "toxic")), strict=True)))
        field = fit([(t, y) for _, _, t, y in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array([field.weights.tobytes()], pa.binary()), pa.array([field.moves.ravel().tolist()], pa.list_(pa.float64())),
             pa.array([field.calibration.tolist()], pa.list_(pa.float64()))], ["weights", "moves", "calibration"])

    one = rows.repartition(1).mapInArrow(fitted, "weights binary, moves array<double>, calibration array<double>").first()
    if one is None:
        return fit([])
    return Field(np.frombuffer(one["weights"], np.float32), np.array(one["moves"]).reshape(2, 2), np.array(one["calibration"]))


def tag(docs: DataFrame, field: Field, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (score >= ``threshold``), spans.

    ``spans`` are the [begin, end) code-point offsets of offending tokens in the whole
    text. Null text counts as empty and gets the calibration's least evidence; repeated
    rows and null ids stay as they are; an empty table gives an empty result.
    """

    def scored(ids: pa.Array, found: list[str], scores: list[np.ndarray]) -> pa.RecordBatch:
        unary, starts, sizes = _joined(scores)
        p = marginals(unary, starts, sizes, field.moves)
        value = 1 / (1 + np.exp(-np.clip(_evidence(p, starts, sizes) @ field.calibration, -30, 30)))
        spans: list[list[dict]] = [[] for _ in found]
        bad = np.nonzero(p >= 0.5)[0]
        owner = np.searchsorted(starts + sizes, bad, side="right")
        for i, at in zip(*np.unique(owner, return_index=True), strict=True):
            hit = set((bad[at:at + np.searchsorted(owner[at:], i, side="right")] - starts[i]).tolist())
            spans[i] = [{"begin": m.start(), "end": m.end()} for k, m in enumerate(_TOKEN.finditer(found[i])) if k in hit]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(value), pa.array((value >= threshold).astype(np.int32)),
             pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))],
            ["doc_id", "score", "predicted", "spans"])

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(field.weights)
        for b in batches:
            scores, first, n = [], 0, 0
            text = b.column("text").to_pylist()
            for i, t in enumerate(text):
                scores.append(words.of(_TOKEN.findall(t)))
                n += len(scores[-1])
                if n >= AT_ONCE or i + 1 == len(text):
                    yield scored(b.column("doc_id").slice(first, i + 1 - first), text[first:i + 1], scores)
                    scores, first, n = [], i + 1, 0

    return texts(docs, id_col, text_col).mapInArrow(
        tagged, "doc_id long, score double, predicted int, spans array<struct<begin:int,end:int>>")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every row; labels of held-out ids are not read."""
    field = train(docs, labels.where(~held_out(F.col("doc_id"))), id_col, text_col)
    return tag(docs, field, threshold, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")
