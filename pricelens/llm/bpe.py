"""Byte-level BPE: ranked merges folded over distinct words by Spark higher-order functions.

One narrow stage, no shuffle:

1. where texts are read, the splitting pattern cuts them into words. A task passes on
   each word once (until ``WORDS`` are known, then its list starts afresh): a row of new
   words, followed by a row of word numbers for each text of the group;
2. ``encoded`` folds the merges over each new word's bytes. The state is a string with
   one character a token; every step looks up all neighbouring pairs in one literal map
   (the value of a scalar subquery, hashed into buckets since a Spark map is searched
   linearly) and replaces the pair of least rank by its merged token;
3. each word's ids are decoded by concatenating their binary pieces; then the numbers of
   a text are replaced by the words' ids and by their decoded bytes, which are joined.

One step replaces all occurrences of the pair, the library the leftmost first; the map
holds one pair a token, the library merges any two neighbours whose bytes are a token and
encodes a word that is a token at once. All this comes to the same if every token's bytes
come down to two pieces under the merges of lower rank alone: no new pair can then rank
below the merge that made it. ``merges`` checks this for every token of a file and refuses
a file for which it doesn't hold.

A word of over ``FOLDED`` bytes (a fold costs the square of its length) is merged in step
3 by the same rule with a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pricelens.llm.common import texts
from pricelens.llm.tokens import read_ranks

#: Words that a task knows at a time; bytes of word numbers between two rows of new words.
WORDS, GROUP_BYTES = 1_250_000, 2 << 20
#: Input splits that one task reads, so that fewer tasks fold the same word.
SPLITS = 5
FOLDED = 512
BUCKETS = 1 << 16


def token_char(token: int) -> str:
    """The character that stands for a token in a fold; their order is that of ranks."""
    return chr(0x10000 + token)


def merges(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left, right, merged) ids of every token of several bytes, in no order."""
    out = []
    for word, rank in ranks.items():
        pieces = [word[i:i + 1] for i in range(len(word))]
        while len(pieces) > 2:
            of = [ranks.get(a + b, rank) for a, b in zip(pieces, pieces[1:], strict=False)]
            if (least := min(of)) >= rank:
                raise ValueError(f"token {rank} doesn't come from merges of lower rank")
            at = of.index(least)
            pieces[at:at + 2] = [pieces[at] + pieces[at + 1]]
        if len(pieces) == 2:
            out.append((ranks[pieces[0]], ranks[pieces[1]], rank))
    return out


def _bucket(pair: Column) -> Column:
    return F.hash(pair).bitwiseAND(F.lit(BUCKETS - 1))


def merge_literal(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The merges as one value: an array of small maps from a pair to its token, by the pair's hash."""
    pairs = spark.createDataFrame([(token_char(a) + token_char(b), token_char(c)) for a, b, c in merges(ranks)],
                                  "pair string, token string")
    buckets: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
    for row in pairs.select(_bucket(F.col("pair")).alias("bucket"), "pair", "token").collect():  # a row for each token
        buckets[row["bucket"]][row["pair"]] = row["token"]
    kind = T.StructType([T.StructField("merges", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])
    return spark.createDataFrame([(buckets,)], kind).scalar()


def encoded(word: Column, literal: Column, ranks: dict[bytes, int]) -> Column:
    """The tokens of a word's bytes, a character each; null for null."""

    def made(tokens: Column, i: Column) -> Column:  # what the i-th pair becomes, null for no token
        pair = F.substring(tokens, i, F.lit(2))
        return F.element_at(F.get(literal, _bucket(pair)), pair)

    def step(state: Column, _: Column) -> Column:
        tokens = state["tokens"]

        def merged(pairs: Column) -> Column:
            best = F.array_min(pairs)
            pair = F.substring(tokens, F.array_position(pairs, best).cast("int"), F.lit(2))
            return F.when(best.isNull(), F.struct(tokens.alias("tokens"), F.lit(False).alias("on"))).otherwise(
                F.struct(F.replace(tokens, pair, best).alias("tokens"), F.lit(True).alias("on")))

        pairs = F.transform(F.sequence(F.lit(1), F.length(tokens) - 1), lambda i: made(tokens, i))
        # An array of one and its transform: the pairs are looked up once for both uses.
        return F.when(state["on"] & (F.length(tokens) > 1), F.get(F.transform(F.array(pairs), merged), F.lit(0))).otherwise(state)

    latin = bytes(range(256)).decode("latin-1")
    start = F.translate(F.decode(word, "ISO-8859-1"), latin, "".join(token_char(ranks[bytes([b])]) for b in range(256)))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))),
                       F.struct(start.alias("tokens"), F.lit(True).alias("on")), step, lambda state: state["tokens"])


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap, in linearithmic time."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def push(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue  # one of its two pieces has changed
        j = after[i]
        alive[j] = False
        end[i], after[i] = stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


#: The usual pattern for texts of ASCII and plain Latin letters alone: the same matches, found faster.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_OTHER = re.compile(f"[^\\x00-\\x1b\\x20-\\x7f{_LATIN}]")
_FAST = re.compile(rf" ?[{_LATIN}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text."""
    whole = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return whole
    return lambda text: whole(text) if _OTHER.search(text) else _FAST.findall(text)


def _cut(whole: bytes, ends: np.ndarray) -> Iterator[bytes]:
    at = ends.tolist()
    return map(whole.__getitem__, map(slice, at[:-1], at[1:]))


#: What ``encode_decode`` returns of a text: everything, or lengths and digests (lowercase hex).
WHOLE = "ids binary, decoded binary", lambda ids, decoded: (ids, decoded)
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda ids, decoded: (
    len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
#: Bytes of ids and text that are turned into rows at a time (more only for one long text).
OUT_BYTES = 4 << 20


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  folded: int = FOLDED, each: tuple[str, Callable[[bytes, bytes], tuple]] = WHOLE) -> DataFrame:
    """One row per input row: doc_id, ids (binary, little-endian unsigned 32-bit), decoded (binary).

    ``each`` (a schema and a function of ids and decoded bytes) makes other columns of
    them where they arise, so that they need not be moved.

    Each match of ``pattern`` is encoded by itself, without special tokens. Null text
    counts as empty (no ids). Repeated rows and null ids stay as they are; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    out_schema = T._parse_datatype_string(f"doc_id long, {each[0]}")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = splitter(pattern)
        number: dict[str, int] = {}

        def rows(new: list[str], fresh: bool, ids: list, refs: list[bytes]) -> pa.RecordBatch:
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([[x.encode() for x in new]] + [None] * n, pa.list_(pa.binary())),
                 pa.array([fresh] + [False] * n), pa.array([None, *ids], pa.int64()), pa.array([None, *refs], pa.binary())],
                ["words", "fresh", "doc_id", "refs"])

        new: list[str] = []
        ids: list = []
        refs: list[bytes] = []
        fresh, held = True, 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found_words = found(text.as_py())
                for w in found_words:
                    if w not in number:
                        number[w] = len(number)
                        new.append(w)
                ids.append(doc)
                refs.append(np.fromiter(map(number.__getitem__, found_words), np.int32, len(found_words)).tobytes())
                held += len(refs[-1])
                if held >= GROUP_BYTES or len(number) >= WORDS:
                    yield rows(new, fresh, ids, refs)
                    new, ids, refs, held = [], [], [], 0
                    if fresh := len(number) >= WORDS:
                        number = {}
        if ids:
            yield rows(new, fresh, ids, refs)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for word, rank in ranks.items():
            pieces[rank] = word
        piece_size = np.array([len(x) for x in pieces], dtype=np.int64)
        ids_of: list[bytes] = []
        text_of: list[bytes] = []
        names = ["doc_id", *(c.split()[0] for c in each[0].split(", "))]
        kinds = to_arrow_schema(out_schema)

        def rows(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kinds.field(n).type) for c, n in zip(zip(*done, strict=True), names, strict=True)], names)

        for b in batches:
            words, long, fresh = b.column("ids"), b.column("long"), b.column("fresh").to_pylist()
            done, held = [], 0
            for i, (doc, refs) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("refs"), strict=True)):
                if words[i].is_valid:
                    if fresh[i]:
                        ids_of, text_of = [], []
                    known, unmerged = len(ids_of), long[i].values
                    tokens = [x or "" for x in words[i].values.to_pylist()]
                    ends = np.cumsum([0, *map(len, tokens)])
                    flat = (np.frombuffer("".join(tokens).encode("utf-32-le"), "<u4") - 0x10000).astype("<u4")
                    ids_of.extend(_cut(flat.tobytes(), 4 * ends))
                    at = np.cumsum(np.append(0, piece_size[flat]))
                    text_of.extend(_cut(b"".join(map(pieces.__getitem__, flat.tolist())), at[ends]))
                    for k in np.nonzero(unmerged.is_valid().to_numpy(zero_copy_only=False))[0].tolist():
                        merged = merge_long(unmerged[k].as_py(), ranks)
                        ids_of[known + k] = np.array(merged, dtype="<u4").tobytes()
                        text_of[known + k] = b"".join(map(pieces.__getitem__, merged))
                    continue
                numbers = np.frombuffer(refs.as_py(), np.int32).tolist()
                body, text = b"".join(map(ids_of.__getitem__, numbers)), b"".join(map(text_of.__getitem__, numbers))
                done.append((doc, *each[1](body, text)))
                held += len(body) + len(text)
                if held >= OUT_BYTES:
                    yield rows(done)
                    done, held = [], 0
            if done:
                yield rows(done)

    rows = texts(docs, id_col, text_col)
    rows = rows.coalesce(max(1, -(-rows.rdd.getNumPartitions() // SPLITS)))
    groups = rows.mapInArrow(split, "words array<binary>, fresh boolean, doc_id long, refs binary")
    # Rows of texts carry no copy of the map.
    ranks = read_ranks(ranks_path)
    held = groups.withColumn("merges", F.when(F.col("words").isNotNull(), merge_literal(spark, ranks)))
    short = F.transform("words", lambda w: encoded(F.when(F.length(w) <= folded, w), F.col("merges"), ranks))
    long = F.transform("words", lambda w: F.when(F.length(w) > folded, w))
    return held.select("fresh", "doc_id", "refs", long.alias("long"), short.alias("ids")).mapInArrow(
        joined, out_schema)
