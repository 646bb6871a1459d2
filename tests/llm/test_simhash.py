import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from pricelens.llm import simhash as S
from pricelens.llm.simhash import components, fingerprint, golay_keys, links, nearby_codewords, simhash_dedup


def plain(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_are_those_of_brute_force(odd):
    for r in odd.select("text").distinct().collect():
        assert fingerprint((r.text or "").encode(), 3) == plain(r.text or "")


def test_the_code_is_perfect():
    near = nearby_codewords()
    assert set((near >= 0).sum(axis=1).tolist()) == {1, 6}
    # Words that differ in one bit have a codeword in common.
    r = np.random.default_rng(0)
    for a in r.integers(0, 1 << 16, 2000).tolist():
        b = a ^ (1 << int(r.integers(0, 16)))
        assert set(near[a][near[a] >= 0].tolist()) & set(near[b][near[b] >= 0].tolist())


def test_every_pair_of_up_to_three_bits_shares_a_key():
    r = random.Random(0)
    for _ in range(3000):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randint(0, 3)):
            b ^= 1 << bit
        ka, kb = (set(golay_keys(np.array([x], dtype=np.uint64))[0].tolist()) for x in (a, b))
        assert ka & kb


def clusters(fps, bits=3):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("block", [2048, 5])
def test_links_connect_what_all_pairs_connect(spark, block):
    r = random.Random(1)
    fps = [0, (1 << 64) - 1]
    for _ in range(12):  # dense and chained families, and strangers
        at = r.getrandbits(64)
        for _ in range(25):
            fps.append(at)
            for bit in r.sample(range(64), r.randint(0, 4)):
                at ^= 1 << bit
    centre = r.getrandbits(64)
    fps += [centre ^ (1 << a) for a in range(64)] + [r.getrandbits(64) for _ in range(100)]
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    rows = spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, node long")
    found = {r.node: r.component for r in components(links(rows, block=block)).collect()}
    want = clusters(fps)
    least = {}
    for i, c in enumerate(want):
        least.setdefault(c, i)
    sizes = Counter(want)
    assert {i: least[c] for i, c in enumerate(want) if sizes[c] > 1 and least[c] != i} == {n: c for n, c in found.items() if n != c}


def test_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 1000 + i) for i in range(300)] + [(7, 7), (1300, 1200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 101))
    assert all(got[1000 + i] == 500 for i in range(300))


def test_documents(odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    fps = [plain(t or "") for _, t in rows]
    least = {}
    for (i, _), c in zip(rows, clusters(fps), strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = Counter((i, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(rows, fps, clusters(fps), strict=True))
    assert Counter(tuple(r) for r in simhash_dedup(odd).collect()) == want


def test_empty_table(documents):
    assert simhash_dedup(documents([])).collect() == []


def test_more_bits_than_the_keys_find_are_refused(documents):
    with pytest.raises(ValueError):
        simhash_dedup(documents([(1, "a")]), max_bits=4)
    assert S.MAX_BITS == 3
