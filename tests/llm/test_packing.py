import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from pricelens.llm.packing import TightestOpen, best_fit_decreasing, pack
from pricelens.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(histogram, size):
    """Best-fit decreasing, piece by piece: the remaining capacities."""
    left = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [c for c in left if c >= length]
            if fits:
                left.remove(min(fits))
                left.append(min(fits) - length)
            else:
                left.append(size - length)
    return Counter(left)


def test_tree_finds_the_tightest():
    r, tree, have = random.Random(0), TightestOpen(37), Counter()
    for _ in range(500):
        c = r.randint(1, 37)
        n = r.randint(-have[c], 3)
        tree.add(c, n)
        have[c] += n
        want = r.randint(1, 37)
        assert tree.find(want) == min((c for c in have if c >= want and have[c]), default=None)


@pytest.mark.parametrize("seed", range(30))
def test_runs_place_as_piece_by_piece(seed):
    r = random.Random(seed)
    size = r.choice([8, 31, 64])
    histogram = {k: r.randint(1, 40) for k in r.sample(range(1, size + 1), r.randint(1, size))}
    runs, n = best_fit_decreasing(histogram, size)
    used, spans = Counter(), defaultdict(list)
    for length in histogram:
        ranks = []
        for l, rank, count, first, offset, each in runs[runs[:, 0] == length].tolist():
            for k in range(count):
                ranks.append(rank + k)
                spans[first + k // each].append((offset + k % each * l, l))
                used[first + k // each] += l
        assert sorted(ranks) == list(range(histogram[length]))
    assert set(used) == set(range(n))
    assert Counter(size - u for u in used.values()) == plain(histogram, size)
    for s in spans.values():  # gapless from 0
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length


def test_documents(odd):
    size = 64
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    got = [r.asDict() for r in pack(odd, PATH, max_len=size).collect()]
    want = Counter()
    for i, t in rows:
        ids = np.append(encoder(PATH).ids(t or ""), np.uint32(0)).astype("<u4")
        start, k = 0, 0
        for end in range((len(ids) - 1) % size + 1, len(ids) + 1, size):
            want[(i, k, start, end - start, zlib.crc32(ids[start:end].tobytes()))] += 1
            start, k = end, k + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    assert len(by) == sum(plain(Counter(r["length"] for r in got), size).values())


def test_empty_table(documents):
    assert pack(documents([]), PATH).collect() == []
