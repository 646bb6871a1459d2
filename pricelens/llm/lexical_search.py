"""Ranked lexical search, exact top k, by a hybrid of term-at-a-time and document-at-a-time.

The queries are taken in blocks of bounded size; a block's terms go to every task. Each
document is cut into terms once a block, where it is read, and leaves its length and its
counts of the block's terms. Corpus counts (documents, terms, documents a term) are sums over
all of them. Then every task inverts its documents, some ten thousands at a time, into lists
sorted by document and answers all queries of the block over them:

* the short lists of a query are read term at a time: their scores are summed into one list of
  accumulators;
* that list, with its greatest sum as bound, is then one iterator among the long lists, and all of
  them are passed document at a time, in windows of documents. A window whose bounds don't reach
  the worst of the k results so far is skipped without a look at its postings. In a window the
  lists that alone can't reach it only score the candidates of the others.

The k best of every task meet by query. Scores are 64-bit integers, so the order of
summation doesn't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import ship, texts, written

#: A term: a maximal run of letters and digits, and of anything beyond ASCII.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Queries and bytes of query text a block aims at; what a task holds of documents and postings.
BLOCK_QUERIES = 2048
BLOCK_BYTES = 4 << 20
SHARD_DOCS = 32_768
SHARD_POSTINGS = 4_000_000
#: Documents a window, and the share of a shard's documents up to which a list is short.
WINDOW = 1024
SHORT = 1 / 64

_VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
_FOUND = "query long, doc_id long, score long"


def terms(text: str) -> list[str]:
    return TERM.findall(text.translate(_LOWER))


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m: 75 and its length against the mean, in 25ths; whole numbers throughout."""
    if not len(n) or 25 * int(n.max()) * n_docs < 2**63:
        return 75 + (25 * n * n_docs) // max(n_terms, 1)
    return np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], dtype=np.int64)


@dataclass
class Best:
    """The k best (score, doc_id) so far: higher scores first, then lesser ids; no id after all ids."""

    k: int
    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    docs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def reaches(self, bound: int, least_doc: int) -> bool:
        """Whether a document from ``least_doc`` on with a score of at most ``bound`` can enter."""
        if bound <= 0:
            return False
        if len(self.scores) < self.k:
            return True
        return bound > self.scores[-1] or (bound == self.scores[-1] and least_doc < self.docs[-1])

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        if len(self.scores) == self.k:
            good = scores >= self.scores[-1]
            scores, docs = scores[good], docs[good]
        scores, docs = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs])
        order = np.lexsort((docs, -scores))[:self.k]
        self.scores, self.docs = scores[order], docs[order]


class Shard:
    """Inverted lists over some documents, numbered by ascending id."""

    def __init__(self, doc_id: np.ndarray, m: np.ndarray, at: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int):
        order = np.argsort(doc_id, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.doc_id, doc = doc_id[order], place[at]
        parts = (1_000_000_000 * tf) // (1000 * tf + 12 * m[at])
        by_term = np.lexsort((doc, term))
        self.doc, self.part = doc[by_term], parts[by_term]
        self.start = np.searchsorted(term[by_term], np.arange(n_terms + 1))
        self.edges = np.arange(0, len(order) + WINDOW, WINDOW)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.start[term], self.start[term + 1]
        return self.doc[lo:hi], self.part[lo:hi]

    def accumulators(self, lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: the sums of several lists, one list sorted by document."""
        doc, inverse = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
        total = np.zeros(len(doc), np.int64)
        np.add.at(total, inverse, np.concatenate([s for _, s in lists]))
        return doc, total

    def search(self, query: list[tuple[int, int]], best: Best) -> None:
        """Enter this shard's documents for a query, (term, factor) pairs, into ``best``."""
        lists = [(d, s * factor) for t, factor in query for d, s in [self.postings(t)] if len(d) and factor]
        short = [x for x in lists if len(x[0]) <= len(self.doc_id) * SHORT]
        lists = [x for x in lists if len(x[0]) > len(self.doc_id) * SHORT]
        if short:
            lists.append(self.accumulators(short))
        if not lists:
            return
        # Where each window begins in each list, and each list's bound in each window.
        cuts = [np.searchsorted(d, self.edges) for d, _ in lists]
        bounds = np.zeros((len(lists), len(self.edges) - 1), np.int64)
        for i, ((_, s), cut) in enumerate(zip(lists, cuts, strict=True)):
            some = cut[:-1] < cut[1:]
            bounds[i, some] = np.maximum.reduceat(s, cut[:-1][some])
        total = bounds.sum(axis=0)
        for w in range(len(total)):
            least = int(self.doc_id[w * WINDOW])
            if best.reaches(int(total[w]), least):
                self._window(w, lists, cuts, bounds[:, w], least, best)

    def _window(self, w: int, lists: list, cuts: list, bound: np.ndarray, least: int, best: Best) -> None:
        order = [int(i) for i in np.argsort(bound, kind="stable") if bound[i] > 0]
        # The lists whose bounds together stay below the worst result bring no candidates of their own.
        below, cannot = 0, 0
        while cannot < len(order) and not best.reaches(below + int(bound[order[cannot]]), least):
            below += int(bound[order[cannot]])
            cannot += 1
        part = lambda i, x: x[cuts[i][w]:cuts[i][w + 1]]
        base = w * WINDOW
        score = np.zeros(WINDOW, np.int64)
        for i in order[cannot:]:
            score[part(i, lists[i][0]) - base] += part(i, lists[i][1])
        doc = np.flatnonzero(score)
        score = score[doc]
        for i in reversed(order[:cannot]):  # the greatest bound first; a candidate that can't enter any more goes
            doc, score = self._alive(doc, score, below, best)
            if not len(doc):
                return
            d, s = part(i, lists[i][0]) - base, part(i, lists[i][1])
            at = np.minimum(np.searchsorted(d, doc), len(d) - 1)
            score = score + np.where(d[at] == doc, s[at], 0)
            below -= int(bound[i])
        if len(doc):
            best.add(score, self.doc_id[doc + base])

    @staticmethod
    def _alive(doc: np.ndarray, score: np.ndarray, more: int, best: Best) -> tuple[np.ndarray, np.ndarray]:
        if len(best.scores) < best.k:
            return doc, score
        stays = score + more >= best.scores[-1]
        return doc[stays], score[stays]


def _blocks(queries: DataFrame) -> int:
    n, size = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return max(math.ceil(n / BLOCK_QUERIES), math.ceil(size / BLOCK_BYTES))


def _vectors(docs: DataFrame, number: dict[str, int]) -> DataFrame:
    """doc_id, n and the counts of the block's terms of every document that has a term."""
    given = docs.sparkSession.sparkContext.broadcast(number)  # at most BLOCK_BYTES of distinct terms

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = given.value
        for b in batches:
            ids, ns, ts, cs = [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                all_terms = terms(text.as_py())
                if all_terms:
                    held = Counter(t for t in map(known.get, all_terms) if t is not None)
                    ids.append(i)
                    ns.append(len(all_terms))
                    ts.append(list(held))
                    cs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(ts, pa.list_(pa.int32())),
                 pa.array(cs, pa.list_(pa.int32()))], ["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(cut, _VECTORS)


#: Stands for a missing id among numpy numbers; results carry null again.
_NO_ID = np.iinfo(np.int64).max


def _searched(vectors: DataFrame, queries: list[list[tuple[int, int]]], n_terms: int, n_docs: int, all_terms: int,
              k: int) -> DataFrame:
    """The k best of each task for each query."""
    given = vectors.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in given.value]
        held: list[pa.RecordBatch] = []
        docs = postings = 0

        def answer() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            doc_id = t["doc_id"].fill_null(_NO_ID).to_numpy()
            n = t["n"].to_numpy()
            lists = t["terms"].combine_chunks()
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = t["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
            at = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
            shard = Shard(doc_id, lengths_norm(n, n_docs, all_terms), at, term, tf, n_terms)
            for query, b in zip(given.value, best, strict=True):
                shard.search(query, b)

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # a batch may hold more than a shard should
                piece = batch.slice(lo, 256)
                held.append(piece)
                docs += piece.num_rows
                postings += len(piece.column(2).flatten())
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    answer()
                    held, docs, postings = [], 0, 0
        if held:
            answer()
        sizes = [len(b.scores) for b in best]
        ids = np.concatenate([b.docs for b in best] or [np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), sizes)), pa.array(ids, mask=ids == _NO_ID),
             pa.array(np.concatenate([b.scores for b in best] or [np.empty(0, np.int64)]))], ["query", "doc_id", "score"])

    return vectors.mapInArrow(search, _FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents of highest score above 0 of each item.

    Equal scores rank by ascending doc_id, a missing id last. Items are the distinct rows of id and
    text; equal texts are searched once. An item without a term, or with terms that no document
    holds, has no rows; null texts have no terms. Documents that occur twice are two documents. Empty tables give
    an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = items.select(items[item_col].cast("long").alias("item_id"),
                         F.coalesce(items[item_text_col].cast("string"), F.lit("")).alias("text")).distinct()
    asked = asked.withColumn("key", F.sha2("text", 256))
    distinct = written(asked.groupBy("key").agg(F.max("text").alias("text")), "queries")
    n_blocks = _blocks(distinct)
    corpus = texts(docs, id_col, text_col)
    out = None
    for block in range(n_blocks):
        mine = distinct.where(F.pmod(F.xxhash64("key"), F.lit(n_blocks)) == block).orderBy("key").collect()
        counts = [Counter(terms(r["text"])) for r in mine]
        number = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        vectors = written(_vectors(corpus, number), "vectors")
        n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r["term"]: r["df"] for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(
            F.count(F.lit(1)).alias("df")).collect()}  # one row a term of the block
        weight = {t: term_weight(n_docs, d) for t, d in df.items()}
        queries = [sorted((number[t], weight[number[t]] * c) for t, c in q.items() if weight.get(number[t]))
                   for q in counts]
        found = _searched(vectors, queries, len(number), n_docs, n_terms, k)
        keys = spark.createDataFrame([(i, r["key"]) for i, r in enumerate(mine)], "query long, key string")
        found = found.join(F.broadcast(keys), "query").select("key", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = written(out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ranked")
    return asked.select("item_id", "key").join(ranked, "key").select("item_id", "rank", "doc_id", "score")
