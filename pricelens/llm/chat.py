"""Chat formatting over prefix trees: shared turns once, depth first.

Template. A turn is ``<|role|>text<|end|>``. Inside a role or text a backslash is written
``\\\\``, ``<`` is ``\\l``, ``|`` is ``\\p`` and ``>`` is ``\\g``, so only the template writes control strings and
every text can be read back.

Tree. A turn's node is its whole path (a hash over all turns up to it), so conversations
that share initial turns share nodes; a tree is what starts with the same first turn.
Conversations in the order of their paths walk the tree depth first, and a node belongs
to the first conversation that has it. Every node is one output row:

* ``ids``, ``n_tokens``: its tokens, written once; ``start``, ``stop``: where they stand in
  the tree's depth-first token sequence;
* ``position``: position id of its first token, as if its conversation stood alone;
* ``ancestors``: the intervals its tokens attend to besides their own, in order;
* ``loss``: whether its text is trained on (the role ``assistant``).

No step gathers a tree, or the texts of a conversation. Rows are turns. Turn numbers and
path hashes are sums and exclusive-ors over blocks of a conversation, then within them;
offsets are sums over ranges of the sorted conversations, then within them. A path that
is collected holds the forks of a conversation only, not its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import ship, written
from pricelens.llm.tokens import encoder

#: Turn numbers that fall into one block of a conversation.
BLOCK = 1024
LOSS_ROLE = "assistant"
_SEGMENT = re.compile(r"<\|([^|]*)\|>([^<]*)<\|end\|>")
_PLAIN = {"\\": "\\", "l": "<", "p": "|", "g": ">"}


def escape(text: Column) -> Column:
    for mark, plain in _PLAIN.items():
        text = F.replace(text, F.lit(plain), F.lit("\\" + mark))
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text) if "\\" in text else text


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    m = _SEGMENT.fullmatch(segment)
    return unescape(m[1]), unescape(m[2])


@dataclass(frozen=True)
class Formatted:
    """``nodes``: a row per node. ``turns``: conv_id, n (turn from 0) and node of every turn."""

    nodes: DataFrame
    turns: DataFrame


def _before(column: str, by: list[str], order: str, how=F.sum) -> Column:
    """The aggregate of the rows before this one (zero for the first)."""
    return F.coalesce(how(column).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0))


def _numbered(convs: DataFrame) -> DataFrame:
    """conv (key, never null), conv_id, n, role, text, node, parent, tree of every turn."""
    rows = convs.select(
        F.coalesce(convs["conv_id"].cast("string"), F.lit("null")).alias("conv"), convs["conv_id"].cast("long").alias("conv_id"),
        convs["turn"].cast("long").alias("turn"), F.coalesce(convs["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(convs["text"].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 53)))).withColumn(
        "digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    here = Window.partitionBy("conv", "block").orderBy("turn", "digest")
    rows = written(rows.withColumn("k", F.row_number().over(here)), "turns")
    sizes = rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("size"))
    first = sizes.select("conv", "block", _before("size", ["conv"], "block").alias("first"))
    rows = rows.join(first, ["conv", "block"]).withColumn("n", F.col("first") + F.col("k") - 1)
    # 180 bits of the turn's number, role and text; their exclusive-or over a path is its hash.
    full = F.sha2(F.concat_ws(":", F.col("n").cast("string"), "digest"), 256)
    rows = rows.select("*", *[F.conv(F.substring(full, 1 + 15 * i, 15), 16, 10).cast("long").alias(f"h{i}") for i in range(3)])
    blocks = rows.groupBy("conv", "block").agg(*[F.bit_xor(f"h{i}").alias(f"b{i}") for i in range(3)])
    blocks = blocks.select("conv", "block", *[_before(f"b{i}", ["conv"], "block", F.bit_xor).alias(f"b{i}") for i in range(3)])
    here = Window.partitionBy("conv", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.bit_xor(f"h{i}").over(here).alias(f"x{i}") for i in range(3)]).join(blocks, ["conv", "block"])
    path = [F.col(f"x{i}").bitwiseXOR(F.col(f"b{i}")) for i in range(3)]
    rows = rows.select(
        "conv", "conv_id", "n", "role", "text", F.concat_ws("-", F.col("n"), *path).alias("node"),
        F.when(F.col("n") > 0, F.concat_ws("-", F.col("n") - 1, *[p.bitwiseXOR(F.col(f"h{i}")) for i, p in enumerate(path)]))
        .alias("parent"))
    return written(rows, "paths")


def _tokenized(nodes: DataFrame, tokenizer_path: str) -> DataFrame:
    """node, parent, n, role, ids, n_tokens of the distinct nodes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer_path).ids
        for b in batches:
            ids = [ids_of(s.as_py()) for s in b.column("segment")]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("node", "parent", "n", "role")), pa.array([x.tolist() for x in ids], pa.list_(pa.int32())),
                 pa.array([len(x) for x in ids], pa.int64())], ["node", "parent", "n", "role", "ids", "n_tokens"])

    segment = F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>"), escape(F.col("text")), F.lit("<|end|>"))
    distinct = nodes.select("node", "parent", "n", "role", "text").distinct()
    return written(distinct.select("node", "parent", "n", "role", segment.alias("segment")).mapInArrow(
        encode, "node string, parent string, n long, role string, ids array<int>, n_tokens long"), "nodes")


def format_chats(convs: DataFrame, tokenizer_path: str) -> Formatted:
    """The conversations (conv_id, turn, role, text) as prefix trees; see the module's docstring.

    Null role or text counts as empty. Rows without a conv_id are one conversation, whose
    id stays null. Turns are in the order of ``turn`` (null first), rows with the same
    number in a fixed order; a repeated row is another turn. An empty table gives no rows.
    """
    ship(convs.sparkSession)
    turns = _numbered(convs)
    nodes = _tokenized(turns, tokenizer_path)

    # The order of conversations: by tree, then by the nodes chosen at forks; a conversation that ends sorts first.
    forks = nodes.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("children")).where("children > 1")
    chosen = nodes.join(forks, "parent").select("node")
    paths = turns.join(chosen, "node").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("n", "node"))).alias("path"))
    roots = turns.where("n = 0").select("conv", F.col("node").alias("tree"))
    order = roots.join(paths, "conv", "left").orderBy("tree", "path", "conv").select(
        "conv", "tree", F.monotonically_increasing_id().alias("rank"))
    order = written(order, "order")

    # A node belongs to the first conversation that has it.
    placed = turns.select("conv", "n", "node").join(order, "conv")
    owner = placed.groupBy("node").agg(F.min("rank").alias("owner"), F.min("tree").alias("tree"))
    owned = nodes.select("node", "n", "n_tokens").join(owner, "node")

    # Tokens before a conversation's own nodes: of earlier ranges of the order (the id's upper bits), then within its range.
    own = owned.groupBy("owner").agg(F.sum("n_tokens").alias("tokens")).withColumn("range", F.shiftright("owner", 33))
    own = written(own, "own")
    ranges = own.groupBy("range").agg(F.sum("tokens").alias("tokens"))  # a row for each partition of the order
    ranges = ranges.select("range", F.coalesce(F.sum("tokens").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    own = own.select("owner", "range", _before("tokens", ["range"], "owner").alias("inside")).join(ranges, "range")
    spread = owned.join(own.select("owner", (F.col("earlier") + F.col("inside")).alias("base")), "owner").withColumn(
        "at", F.col("base") + _before("n_tokens", ["owner"], "n"))
    spread = written(spread.select("node", "tree", "owner", "n_tokens", "at"), "spread")
    trees = spread.groupBy("tree").agg(F.min("at").alias("zero"))
    spread = spread.join(trees, "tree").select("node", "tree", "owner", "n_tokens", (F.col("at") - F.col("zero")).alias("start"))

    # Along each path: position ids, and the stretches that belong to other conversations.
    along = placed.select("conv", "rank", "n", "node").join(spread, "node").withColumn("stop", F.col("start") + F.col("n_tokens"))
    along = written(along.withColumn("position", _before("n_tokens", ["conv"], "n")), "along")
    stretches = along.groupBy("rank", "owner").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    others = stretches.where("owner != rank").groupBy("rank").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("others"))
    mine = stretches.where("owner = rank").select("rank", F.col("start").alias("own_start"))
    kept = along.where("owner = rank").join(mine, "rank").join(others, "rank", "left")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    ancestors = F.concat(F.coalesce("others", none), F.when(
        F.col("start") > F.col("own_start"), F.array(F.struct(F.col("own_start").alias("start"), F.col("start").alias("stop"))))
        .otherwise(none))
    kept = kept.select("node", "tree", "start", "stop", "position", ancestors.alias("ancestors"))
    out = nodes.join(kept, "node").select(
        "tree", "node", "parent", "n", "role", "ids", "n_tokens", "start", "stop", "position", "ancestors",
        (F.col("role") == LOSS_ROLE).alias("loss"))
    return Formatted(written(out, "formatted"), turns.select("conv", "conv_id", "n", "node"))


def read_back(formatted: Formatted, tokenizer_path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation.

    Each conversation's nodes are decoded from their token ids and parsed; a conversation
    streams through its task turn by turn, and its digests are updated as it passes.
    """
    rows = formatted.turns.join(formatted.nodes.select("node", "ids", "loss"), "node")
    rows = rows.select("conv", "conv_id", "n", "ids", "loss").repartition("conv").sortWithinPartitions("conv", "n")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(tokenizer_path).decode
        state: list = []  # conv, conv_id, turns, digest, loss characters, loss digest, characters

        def result(done: list[list]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            cols = [[s[1] for s in done], [s[2] for s in done], [s[3].hexdigest() for s in done], [s[4] for s in done],
                    [s[5].hexdigest() for s in done], [s[6] for s in done]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            done = []
            for conv, conv_id, ids, loss in zip(*(b.column(c) for c in ("conv", "conv_id", "ids", "loss")), strict=True):
                if not state or state[0] != conv.as_py():
                    if state:
                        done.append(state)
                    state = [conv.as_py(), conv_id.as_py(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                segment = decode(ids.values.to_numpy())
                role, text = parse(segment)
                state[2] += 1
                state[3].update(f"{role}\n{text}\n".encode())
                if loss.as_py():
                    state[4] += len(text)
                    state[5].update(text.encode())
                state[6] += len(segment)
            if done:
                yield result(done)
        if state:
            yield result([state])

    return rows.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                 "formatted_chars long")
