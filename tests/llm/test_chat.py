import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pricelens.llm import chat
from pricelens.llm.chat import escape, format_chats, parse, read_back
from pricelens.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["", "\\", "<|end|>", "<|assistant|>x", "a<", "|>b", "<\\|", "\\\\<|", "<|>", "\n", "</s>[INST] ok [/INST]", "<|endoftext|>", "日本 é 🏳️‍🌈"]


def forest(seed, n=60):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, 7)):
            role = ["system", "user", "assistant"][0 if t == 0 and c % 2 else 1 + t % 2]
            rows.append((c, t, role, r.choice(NASTY[:4]) if t > 1 else f"open {r.randint(0, 1)}"))
    rows += [(1000 + i, t, "user" if t % 2 == 0 else "assistant", x) for i in range(25) for t, x in enumerate(["same", "copy", "chat"])]
    rows += [(2000, 0, None, None), (None, 0, "user", "no id"), (None, 1, "assistant", "still"), (2001, None, "user", "first"),
             (2001, 3, "assistant", "b"), (2001, 3, "assistant", "a"), (2002, 1, "a|>b<|", "x"), (2003, 5, "user", "dup"), (2003, 5, "user", "dup")]
    rows += [(3000, t, "assistant" if t % 2 else "user", f"{NASTY[t % len(NASTY)]} {t}") for t in range(150)]
    rows += [(3001, t, "assistant" if t % 2 else "user", f"{NASTY[t % len(NASTY)]} {t}") for t in range(140)]
    return rows


def in_order(rows):
    def key(x):
        _, t, role, text = x
        role, text = role or "", text or ""
        return (t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest())

    by = defaultdict(list)
    for x in rows:
        by[x[0]].append(x)
    return {c: [(x[2] or "", x[3] or "") for x in sorted(xs, key=key)] for c, xs in by.items()}


def test_escaping_is_reversible(spark):
    r = random.Random(0)
    texts = NASTY + ["".join(r.choice("\\<|>a ") for _ in range(r.randint(0, 12))) for _ in range(2000)]
    df = spark.createDataFrame([(t, texts[-i - 1]) for i, t in enumerate(texts)], "role string, text string")
    for row in df.select("*", F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>"), escape(F.col("text")), F.lit("<|end|>")).alias("s")).collect():
        assert parse(row.s) == (row.role, row.text)
        assert row.s.count("<|") == 2 and row.s.count("|>") == 2  # only the template writes control strings


@pytest.mark.parametrize("block", [chat.BLOCK, 2])
def test_prefix_trees(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows = forest(block)
    convs = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("clash")).repartition(4)
    made = format_chats(convs, PATH)
    nodes = {r["node"]: r for r in made.nodes.collect()}
    paths = defaultdict(list)
    for r in sorted(made.turns.collect(), key=lambda r: r.n):
        paths[r.conv_id].append(r["node"])
    want = in_order(rows)
    assert set(paths) == set(want)
    # Nodes are exactly the distinct paths.
    prefixes = {tuple(turns[:k + 1]) for turns in want.values() for k in range(len(turns))}
    assert len(nodes) == len(prefixes) and sum(map(len, paths.values())) == len(rows)
    # Shared tokens stand once: the nodes tile their tree without gaps, a subtree is one stretch (depth first).
    trees = defaultdict(list)
    for r in nodes.values():
        trees[r.tree].append(r)
    assert len(trees) == len({p[0] for p in prefixes if len(p) == 1})
    children = defaultdict(list)
    for tree in trees.values():
        at = 0
        for r in sorted(tree, key=lambda r: (r.start, r.stop)):
            assert r.start == at and r.stop == at + r.n_tokens == at + len(r.ids)
            at = r.stop
            children[r.parent].append(r["node"])
    decode = encoder(PATH).decode
    for conv, path in paths.items():
        before = []
        for name, turn in zip(path, want[conv], strict=True):
            r = nodes[name]
            assert parse(decode(np.array(r.ids))) == turn and r.loss == (turn[0] == "assistant")
            assert r.position == sum(b - a for a, b in before)
            seen = [x for a, b in r.ancestors for x in range(a, b)]
            assert seen == [x for a, b in sorted(before) for x in range(a, b)]
            assert before == sorted(before) and all(b <= r.start for _, b in before)
            before.append((r.start, r.stop))

    def extent(name):
        inner = [extent(c) for c in children[name]]
        lo, hi = nodes[name].start, max([nodes[name].stop, *(b for _, b, _ in inner)])
        size = nodes[name].n_tokens + sum(s for _, _, s in inner)
        assert hi - lo == size
        return lo, hi, size

    for root in children[None]:
        extent(root)


def test_read_back(spark):
    rows = forest(5)
    got = Counter(tuple(r) for r in read_back(format_chats(spark.createDataFrame(rows, SCHEMA), PATH), PATH).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter()
    for c, turns in in_order(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want[(c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))] += 1
    assert got == want


def test_empty_table(spark):
    made = format_chats(spark.createDataFrame([], SCHEMA), PATH)
    assert made.nodes.collect() == [] and read_back(made, PATH).collect() == []
