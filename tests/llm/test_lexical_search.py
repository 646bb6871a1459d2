"""Lexical search: every score of every document against plain arithmetic; ties, copies, odd rows, small windows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pricelens.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    """Ranked rows of each distinct item, scores by the formula over all documents."""
    bags = [(i, Counter(cut(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    n_terms = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = set()
    for item, text in set(items):
        scored = []
        for i, b in bags:
            s = 0
            for t, q in Counter(cut(text)).items():
                if b[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + 25 * b.total() * n_docs // n_terms
                    s += q * w * (1000000000 * b[t] // (1000 * b[t] + 12 * m))
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out |= {(item, r, i, -s) for r, (s, _, i) in enumerate(scored[:k], 1)}
    return out


def rows(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture
def small(monkeypatch):
    """Several blocks on few queries (shards and windows are cut in the test of shards)."""
    monkeypatch.setattr(L, "BLOCK_QUERIES", 5)


def test_shard_against_all_scores(monkeypatch):
    """Directly, over many random shards: skipping loses nothing, ties included."""
    monkeypatch.setattr(L, "WINDOW", 3)
    for seed in range(60):
        r = np.random.default_rng(seed)
        monkeypatch.setattr(L, "SHORT", [0, 0.1, 0.5, 2][seed % 4])
        best, every = L.Best(3), []
        query = [(t, int(r.integers(0, 4))) for t in range(6)]
        for _ in range(4):  # results go on from shard to shard
            n = int(r.integers(1, 40))
            ids, m = r.permutation(1000)[:n], r.integers(75, 80, n)
            held = [(d, t) for d in range(n) for t in range(6) if r.random() < 0.1 + t / 8]
            at, term = (np.array([x[j] for x in held], dtype=np.int64) for j in (0, 1))
            tf = r.integers(1, 3, len(held))
            L.Shard(ids, m, at, term, tf, 6).search(query, best)
            score = Counter()
            for d, t, f in zip(at, term, tf, strict=True):
                score[int(ids[d])] += query[t][1] * int(1000000000 * int(f) // (1000 * int(f) + 12 * int(m[d])))
            every += [(-s, i) for i, s in score.items() if s]
        assert list(zip((-best.scores).tolist(), best.docs.tolist(), strict=True)) == sorted(every)[:3]


def test_against_all_scores(spark, documents, small):
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["É", "éa", "x1"]
    docs = [(i, " ".join(r.choices(words, [1 / (j + 1) for j in range(43)], k=r.randint(0, 60)))) for i in range(150)]
    docs += [(200 + i, docs[3][1]) for i in range(30)] + [docs[3]]  # copies and a repeated row: ties
    items = [(i, " ".join(r.choices(words, k=8))) for i in range(12)] + [(50, "w0 W0 w0 É"), (51, docs[3][1]), (51, docs[3][1]),
             (52, docs[3][1]), (53, "none such"), (54, ""), (55, None), (None, "w1 w2")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = rows(L.search(documents(docs), table))
    want = brute(docs, [(i, t or "") for i, t in items])
    assert {x for x in got if x[0] is not None} == {x for x in want if x[0] is not None}
    assert got == want and len(got) > 200


def test_odd_rows(spark, odd, small):
    items = [(1, "one two"), (2, "日本語 テキスト"), (3, "wörd"), (4, "THE don t"), (5, "x" * 2000)]
    table = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, score string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows(L.search(odd, table)) == brute(docs, items)
    assert L.search(odd.limit(0), table).count() == 0
    assert L.search(odd, table.limit(0)).count() == 0


def test_long_lengths_stay_whole_numbers():
    n = np.array([1, 10**12], dtype=np.int64)
    assert L.lengths_norm(n, 10**9, 10**13).tolist() == [75 + 25 * 10**9 // 10**13, 75 + 25 * 10**21 // 10**13]
