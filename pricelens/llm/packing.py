"""Best-fit-decreasing packing of token pieces into sequences of bounded length.

Equal lengths are interchangeable to best fit, so the packing is decided on the
histogram of lengths (one row per length, at most ``max_len`` rows whatever the corpus)
and carried out in parallel:

1. every document is tokenized and cut where it is read; a piece knows its partition and
   its rank among that partition's pieces of the same length;
2. the counts by (length, partition) give every partition a first rank by length, and
   summed, the histogram;
3. ``best_fit_decreasing`` packs the histogram. A segment tree over remaining capacities
   finds the tightest open sequence in logarithmic time; equal sequences are taken a run
   at a time. The result is a list of runs, whose number depends on ``max_len`` alone;
4. each piece looks up the run of its rank.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import texts, written
from pricelens.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


class TightestOpen:
    """Segment tree over remaining capacities: how many sequences are open at each."""

    def __init__(self, max_len: int):
        self.size = 1 << max_len.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, capacity: int, count: int) -> None:
        at = capacity + self.size
        while at:
            self.open[at] += count
            at >>= 1

    def find(self, length: int) -> int | None:
        """The least capacity of at least ``length`` with an open sequence."""
        at = length + self.size
        if self.open[at]:
            return length
        while at > 1:  # up to the first right sibling that has one, then down its left side
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], max_len: int) -> tuple[np.ndarray, int]:
    """Runs (length, rank, count, sequence, offset, each) and the number of sequences.

    The pieces of ``length`` with ranks from ``rank`` to ``rank + count - 1`` go into
    consecutive sequences from ``sequence`` on, ``each`` of them into one, the first at
    ``offset``. The placement is that of best-fit decreasing piece by piece: a piece that
    fits into a sequence leaves it the tightest, so it is filled before the next.
    """
    tree, at_capacity = TightestOpen(max_len), [deque() for _ in range(max_len + 1)]
    runs, sequences = [], 0

    def put(length: int, rank: int, capacity: int, first: int, bins: int, each: int, count: int) -> None:
        runs.append((length, rank, count, first, max_len - capacity, each))
        left = capacity - each * length
        if left:
            at_capacity[left].append((first, bins))
            tree.add(left, bins)

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            capacity = tree.find(length)
            if capacity is None:
                capacity = max_len
                each = capacity // length
                first, bins = sequences, -(-todo // each)
                sequences += bins
            else:
                each = capacity // length
                first, bins = at_capacity[capacity].popleft()
                tree.add(capacity, -bins)
            full = min(bins, todo // each)
            if full:
                put(length, rank, capacity, first, full, each, full * each)
                todo, rank, first, bins = todo - full * each, rank + full * each, first + full, bins - full
            if bins and 0 < todo < each:
                put(length, rank, capacity, first, 1, todo, todo)
                todo, rank, first, bins = 0, rank + todo, first + 1, bins - 1
            if bins:
                at_capacity[capacity].appendleft((first, bins))
                tree.add(capacity, bins)
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 6), sequences


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut only if longer than ``max_len``.

    All pieces of a cut document but the first have ``max_len`` tokens.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, part, seen = encoder(tokenizer_path).ids, TaskContext.get().partitionId(), {}
        for b in batches:
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                body = np.append(ids(text.as_py()), np.uint32(end_id)).astype("<u4")
                ends = range((len(body) - 1) % max_len + 1, len(body) + 1, max_len)
                start = 0
                for k, end in enumerate(ends):
                    length = end - start
                    rank = seen.get(length, 0)
                    seen[length] = rank + 1
                    out.append((doc, k, start, length, zlib.crc32(body[start:end].tobytes()), part, rank))
                    start = end
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return texts(docs, id_col, text_col).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A sequence's pieces fill it from offset 0 without gaps, ``max_len`` tokens at most.
    Null text counts as empty: the document is ``end_id`` alone. Repeated rows and rows
    with a null id are packed like any others; an empty table gives an empty result.
    """
    cut = written(pieces(docs, tokenizer_path, max_len, end_id, id_col, text_col), "pieces")
    counts = written(cut.groupBy("length", "part").agg((F.max("rank") + 1).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = best_fit_decreasing(histogram, max_len)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("base"))
    # ``base`` grows with the number of partitions: never broadcast.
    ranked = cut.join(base.hint("merge"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = runs[:, 0] * (1 << 48) + runs[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            run = runs[np.searchsorted(keys, length * (1 << 48) + rank, side="right") - 1]
            k = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(run[:, 3] + k // run[:, 5]), pa.array(run[:, 4] + k % run[:, 5] * length)],
                [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                     "sequence_id long, offset long")
