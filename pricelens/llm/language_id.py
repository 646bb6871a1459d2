"""Language identification by cross-parsing.

For every language a suffix automaton is built over a bounded sample of labelled text. A
text is cut, left to right, into the longest phrases that occur in a language's sample: from
each phrase's start the automaton is followed as far as it goes, which yields the longest
match there. Phrases per byte, times the logarithm of the sample's length, estimate
the cross entropy of text and language (Ziv and Merhav). The samples of all languages have one
bound, so one factor normalises all of them; the language that needs the fewest phrases
wins, the least language value among equals.

Texts are compared lower-cased, each run without letters and marks as one blank, byte by
byte in UTF-8. Whole texts are parsed where they are read: no shuffle but that of the sample's
ids. The texts of a batch are parsed side by side, a byte of each at a step.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import ship, texts

#: Documents of the sample a language, and characters taken from each of them.
SAMPLE_DOCS = 96
SAMPLE_CHARS = 512
#: More languages than this are refused: each has a table of some 10 to 100 MB in every worker.
MAX_LANGUAGES = 50
#: With fewer texts than this left in a batch, each is parsed to its end by itself.
SIDE_BY_SIDE = 32
UNKNOWN = "und"

_OUT = "doc_id long, held_out boolean, lang_pred string, score double, phrases_per_byte double"


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """By code point: is it a letter, is it a letter or mark."""
    letter, kept = np.zeros(sys.maxunicode + 1, bool), np.zeros(sys.maxunicode + 1, bool)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(sys.maxunicode + 1))
    for table, pattern in ((letter, r"\p{L}+"), (kept, r"[\p{L}\p{M}]+")):
        for m in regex.finditer(pattern, every):
            table[m.start():m.end()] = True
    return letter, kept


def normalised(text: str) -> bytes:
    """Lower case, every run of other characters than letters and marks as one blank, in UTF-8; nothing
    for a text without a letter."""
    letter, kept = _classes()
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    if not letter[points].any():
        return b""
    keeps = kept[points]
    first = np.ones(len(points), bool)
    first[1:] = keeps[:-1]
    return np.where(keeps, points, 32)[keeps | first].astype("<u4").tobytes().decode("utf-32-le").encode()


def _substring_steps(data: bytes) -> list[dict[int, int]]:
    """The suffix automaton of ``data``: of each state, the next state by byte; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            target = step[at][c]
            if length[at] + 1 != length[target]:
                # The longer strings of ``target`` go on apart: a copy takes the shorter ones.
                step.append(dict(step[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                copy = len(step) - 1
                link[target] = copy
                while at >= 0 and step[at].get(c) == target:
                    step[at][c] = copy
                    at = link[at]
                target = copy
            link[new] = target
        last = new
    return step


class Automaton:
    """The substrings of a sample as a table: a row a state, a column a byte that occurs.

    Where a match can't go on, the entry is the state after the byte as a phrase's first, with
    ``BEGINS`` added; a byte that never occurs is a phrase of its own and leads to the start.
    """

    BEGINS = 1 << 30

    def __init__(self, data: bytes):
        step = _substring_steps(data)
        seen = sorted(set(data))
        self.column = np.zeros(256, np.uint8 if len(seen) < 256 else np.uint16)
        self.column[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        begin = np.full(width, self.BEGINS, np.int32)
        for c, to in step[0].items():
            begin[self.column[c]] = self.BEGINS + to * width
        table = np.tile(begin, (len(step), 1))
        for i, nexts in enumerate(step[1:], 1):
            for c, to in nexts.items():
                table[i, self.column[c]] = to * width
        self.table = table.ravel()

    def count_phrases(self, data: list[bytes]) -> np.ndarray:
        """How many longest matches cover each text."""
        order = sorted(range(len(data)), key=lambda i: -len(data[i]))
        sizes = np.array([len(data[i]) for i in order], np.int64)
        columns = self.column[np.frombuffer(b"".join(data[i] for i in order), np.uint8)]
        at = np.cumsum(sizes) - sizes
        state, n = np.zeros(len(data), np.int32), np.zeros(len(data), np.int64)
        together = int(sizes[SIDE_BY_SIDE - 1]) if len(sizes) >= SIDE_BY_SIDE else 0
        left = len(sizes) - np.searchsorted(sizes[::-1], np.arange(together), side="right")  # texts longer than t
        for t, k in enumerate(left.tolist()):
            to = self.table[state[:k] + columns[at[:k] + t]]
            n[:k] += to >> 30
            state[:k] = to & (self.BEGINS - 1)
        table = memoryview(self.table)
        for i in range(int(np.searchsorted(-sizes, -together, side="left"))):
            s, begun = int(state[i]), 0
            for c in columns[at[i] + together:at[i] + sizes[i]].tolist():
                s = table[s + c]
                if s >= self.BEGINS:
                    begun += 1
                    s -= self.BEGINS
            n[i] += begun
        out = np.empty(len(data), np.int64)
        out[order] = n
        return out


def held_out(doc_id: Column | str, fold: int = 1) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3. No id: not held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == fold, F.lit(False))


def sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, id_col: str = "doc_id",
           text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, piece: of each language at most ``sample_docs`` documents that are not held out and
    have a letter, chosen by hash, and of each a piece of ``sample_chars`` characters from a hashed place.

    The ids are chosen first (each task passes on ``sample_docs`` a language), then their texts are cut.
    Rows without an id or language are not learned from.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[lang_col].cast("string").alias("lang"),
                       docs[text_col].cast("string").alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id"))
    rows = rows.withColumn("order", F.xxhash64("doc_id", "lang"))
    least = Window.partitionBy("lang").orderBy("order", "doc_id")
    ids = (rows.where(F.col("text").rlike(r"\p{L}")).select("lang", "doc_id", "order")
           .withColumn("n", F.row_number().over(least)).where(F.col("n") <= sample_docs).drop("n", "order").distinct())
    room = F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1
    at = (F.pmod(F.xxhash64("text"), room.cast("long")) + 1).cast("int")
    pieces = rows.join(F.broadcast(ids), ["lang", "doc_id"]).select(
        "lang", "order", "doc_id", F.substr("text", at, F.lit(sample_chars)).alias("piece"))
    # Repeated ids bring more rows than were chosen: the bound holds for rows.
    return pieces.withColumn("n", F.row_number().over(least.orderBy("order", "doc_id", "piece"))).where(
        F.col("n") <= sample_docs).select("lang", "n", "piece")


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
          max_languages: int = MAX_LANGUAGES, **cols: str) -> dict[str, bytes]:
    """The normalised sample of each language (``sample_docs`` times ``sample_chars`` characters at most),
    read to the driver; a language without a letter in its sample is not learned."""
    rows = sample(docs, sample_docs, sample_chars, **cols).limit(max_languages * sample_docs + 1).collect()
    pieces: dict[str, list] = {}
    for r in rows:
        pieces.setdefault(r["lang"], []).append((r["n"], normalised(r["piece"])))
    if len(pieces) > max_languages or len(rows) > max_languages * sample_docs:
        raise ValueError(f"more than {max_languages} languages to learn")
    found = {lang: b" ".join(t for _, t in sorted(ts) if t) for lang, ts in sorted(pieces.items())}
    return {lang: t for lang, t in found.items() if t}


_BUILT: dict[str, dict[str, Automaton]] = {}


def automata(samples: dict[str, bytes]) -> dict[str, Automaton]:
    """The automaton of each language, built once a worker process."""
    key = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = {lang: Automaton(text) for lang, text in sorted(samples.items())}
    return _BUILT[key]


def identify(batch: list[str], known: dict[str, Automaton], bits: float) -> list[tuple[str, float, float]]:
    """(language, score, phrases a byte) of each text; ``bits`` is what naming a phrase costs.

    The score is the share of the winner among 2 to the power of minus each language's bits.
    """
    data = [normalised(t) for t in batch]
    if not known:
        return [(UNKNOWN, 0.0, 0.0)] * len(data)
    names = sorted(known)
    phrases = np.array([known[lang].count_phrases(data) for lang in names])
    best = phrases.argmin(axis=0)  # the first of equals
    fewest = phrases.min(axis=0) if len(data) else phrases
    score = 1 / np.exp2(np.maximum((fewest - phrases) * bits, -1000.0)).sum(axis=0)
    return [(names[b], float(s), int(n) / len(d)) if d else (UNKNOWN, 0.0, 0.0)
            for b, s, n, d in zip(best, score, fewest, data, strict=True)]


def identify_languages(docs: DataFrame, samples: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score (0 to 1), phrases_per_byte.

    ``samples`` are the languages' texts (``learn``). A null or empty text and one without a letter
    get ``und`` and score 0; so does every text if no language was learned. Repeated rows and rows
    without an id keep their rows; an empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    bits = math.log2(max([2, *map(len, samples.values())]))
    given = spark.sparkContext.broadcast(samples)  # bounded: MAX_LANGUAGES samples of bounded length

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = automata(given.value)
        for b in batches:
            found = identify(b.column(2).to_pylist(), known, bits)
            lang, score, rate = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rate, pa.float64())], ["doc_id", "held_out", "lang_pred", "score", "phrases_per_byte"])

    rows = texts(docs, id_col, text_col).select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return rows.mapInArrow(parsed, _OUT)
