"""SimHash near-deduplication by Golay-code fuzzy hashing.

Fingerprints: majority vote over the XXH64 hashes of a text's word shingles, 64 bits.

Candidate search. A fingerprint has four segments of 16 bits. If two fingerprints differ
in at most three bits, some segment i is equal in both and segment i + 1 (cyclically)
differs in at most one bit:

* errors (3,0,0,0): three segments are equal, so two of them are neighbours;
* errors (2,1,0,0): each of the two equal segments has one successor, and only one of
  the two successors can be the segment with two errors;
* errors (1,1,1,0) and fewer: the successor of the equal segment has one error at most.

A segment is a word of the perfect binary Golay code [23,12,7], its upper seven bits zero.
Every word lies within three bits of exactly one codeword; listing all codewords within
four bits (one, or six) gives words that differ in one bit a codeword in common. The keys
of a fingerprint are (i, bits of segment i, index of a codeword near segment i + 1): at
most 24. Fingerprints that share a key are compared bit by bit, so no link is missed and
none is made up.

Hot keys. Distinct fingerprints only are keyed, and keys are dealt out in blocks: a key
with more than ``BLOCK`` fingerprints is split into blocks, and every pair of blocks is a
group of its own. A group emits a spanning forest of its links, never all its pairs; the
forest has the same components.

Components: alternating large-star and small-star steps over the links, each written to
the shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import text_key, texts, written

SEED = 42
MAX_BITS = 3
#: Fingerprints of a key that one group compares at most with as many others.
BLOCK = 2048
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit SimHash of UTF-8 ``text``, ASCII letters lower-cased; no word: zero."""
    found = _WORD.findall(text.lower())
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(found) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    return majority(np.array(hashes, dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The word whose bits are set in over half of ``hashes``."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[k:k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text",
                 keyed: bool = False) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's bits as a signed long) of every row; with ``keyed`` also ``text_key``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = pc.cast(b.column(1), pa.binary())
            fps = np.fromiter((fingerprint(x.as_py(), shingle) for x in raw), np.uint64, len(raw))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]],
                                             ["doc_id", "fp", *b.schema.names[2:]])

    rows = texts(docs, id_col, text_col)
    if keyed:
        rows = rows.withColumn("text_key", text_key("text"))
    return rows.mapInArrow(hashed, "doc_id long, fp long" + (", text_key binary" if keyed else ""))


@lru_cache(maxsize=1)
def nearby_codewords() -> np.ndarray:
    """For each 16-bit segment the indices of the codewords within four bits (-1: no more)."""
    index = np.arange(1 << 12, dtype=np.int64)
    rest = index << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    words = (index << 11) | rest
    out = np.full((1 << 16, 6), -1, np.int16)
    for at in range(0, 1 << 16, 512):
        near = np.bitwise_count(np.arange(at, at + 512)[:, None] ^ words[None, :]) <= 4
        row, col = np.nonzero(near)
        first = np.searchsorted(row, np.arange(512))
        out[at + row, np.arange(len(row)) - first[row]] = col
    return out


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the fingerprints (uint64) and the position of each key's fingerprint."""
    segments = [(fps >> np.uint64(16 * i)).astype(np.int64) & 0xFFFF for i in range(4)]
    keys, rows = [], []
    near = nearby_codewords()
    for i in range(4):
        codes = near[segments[(i + 1) % 4]]
        row, col = np.nonzero(codes >= 0)
        keys.append((i << 28) | (segments[i][row] << 12) | codes[row, col])
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps, nodes = b.column("fp").to_numpy(), b.column("node").to_numpy()
        for at in range(0, len(fps), 4096):
            keys, rows = golay_keys(fps[at:at + 4096].view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(fps[at:at + 4096][rows]), pa.array(nodes[at:at + 4096][rows])],
                ["key", "fp", "node"])


def _forest(fps: np.ndarray, nodes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a group as stars: every node that is not the least of its component, and that least."""
    least = np.arange(len(fps))
    left = np.ones(len(fps), bool)
    for start in range(len(fps)):
        if not left[start]:
            continue
        left[start] = False
        found = [start]
        while found:  # breadth first over what has not been reached
            at = found.pop()
            rest = np.nonzero(left)[0]
            if not len(rest):
                break
            hit = rest[np.bitwise_count(fps[rest] ^ fps[at]) <= max_bits]
            left[hit] = False
            least[hit] = start
            found.extend(hit.tolist())
    moved = np.nonzero(least != np.arange(len(fps)))[0]
    return nodes[moved], nodes[least[moved]]


def _links(group: np.ndarray, fps: np.ndarray, nodes: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links inside the groups of rows sorted by group."""
    starts = np.nonzero(np.r_[True, group[1:] != group[:-1]])[0]
    sizes = np.diff(np.r_[starts, len(group)])
    out = []
    small = np.repeat(sizes <= 16, sizes)
    for k in range(1, 16):  # groups of up to 16: compare each row with the k-th after it
        same = np.nonzero((group[k:] == group[:-k]) & small[k:])[0]
        if not len(same):
            break
        hit = same[np.bitwise_count(fps[same] ^ fps[same + k]) <= max_bits]
        if len(hit):
            out.append((nodes[hit], nodes[hit + k]))
    for at in np.nonzero(sizes > 16)[0]:
        part = slice(starts[at], starts[at] + sizes[at])
        out.append(_forest(fps[part], nodes[part], max_bits))
    return out


def links(classes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (u, v), u < v, between the nodes of ``classes`` (fp, node; fp distinct).

    They connect exactly what the links of all pairs within ``max_bits`` connect.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the keys find links of three bits at most")
    keyed = written(classes.mapInArrow(_keyed, "key long, fp long, node long"), "simhash-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keyed.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp", "node"))
    dealt = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, a, b, fps, nodes = cols
            group = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            for u, v in _links(group, fps.view(np.uint64), nodes, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

        held: list[np.ndarray] | None = None
        for b in batches:
            cols = [b.column(n).to_numpy() for n in ("key", "a", "b", "fp", "node")]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            # The last group may go on in the next batch.
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            cut = len(last) - int(last.sum())
            held = [x[cut:] for x in cols]
            if cut:
                yield from emit([x[:cut] for x in cols])
        if held is not None and len(held[0]):
            yield from emit(held)

    return dealt.mapInArrow(compared, "u long, v long").where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (least node reachable) of every node that has a link.

    Alternating large-star and small-star steps, one written table a round. A node's least
    neighbour is aggregated on the map side and joined back, so a node with very many
    links is never one task's group. The rounds end when the links are stars: every node
    but a centre has one link, to a centre that is no other's leaf. Each step keeps the
    components and links every leaf to a smaller node, so centres are the least nodes.
    """
    edges = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u != v")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        # From a node's larger neighbours to the least node beside it, itself included.
        large = both.join(least, "u").where("v > u").select("m", F.col("v").alias("n"))
        least = large.groupBy("n").agg(F.min("m").alias("c"))
        # From a node and its smaller neighbours to the least of those.
        small = (large.join(least, "n").select(F.col("c").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select(F.col("c").alias("u"), F.col("n").alias("v"))))
        edges = written(small.where("u != v").distinct(), "stars")
        roles = edges.select(F.col("v").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionAll(
            edges.select(F.col("u").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
        roles = roles.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
        if roles.where("leaf + centre > 1").isEmpty():
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component"))


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                  text_col: str = "text", block: int = BLOCK, keyed: bool = False) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    With ``keyed`` also ``text_key`` (see ``common.text_key``), which with doc_id finds the
    row again, and ``component``, a value of the component alone: components whose least
    doc_id is the same repeated id differ in it.

    Texts link when their fingerprints differ in ``max_bits`` bits or fewer;
    ``component_id`` is the least doc_id reachable over links, the row's own included.

    Null text counts as empty; a text without a word has fingerprint zero and links like
    any other; a text of up to ``shingle`` words is one shingle. Repeated rows get the
    same answer. A null doc_id gets its component's id, null only if the component's
    texts all lack one. An empty table gives an empty result.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col, keyed), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    # A class is known by its fingerprint (any class, also one without an id, links).
    found = components(links(classes.select("fp", F.col("fp").alias("node")), max_bits, block))
    placed = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    placed = written(placed, "placed")
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = placed.join(ids, "component").select("fp", "component_id", *(["component"] if keyed else []))
    return fps.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        "component_id", *(["text_key", "component"] if keyed else []))
