import hashlib
import string
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pricelens.llm.exact_dedup import exact_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = Counter()
    for i, t in rows:
        norm = (t or "").translate(LOWER)
        ids = [x for x in groups[norm] if x is not None]
        best = keep(ids) if ids else None
        out[(i, best, len(groups[norm]), i == best, hashlib.sha256(norm.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_groups_are_those_of_brute_force(odd, keep, weak):
    # A hash of two values makes nearly every text collide: bytes decide.
    how = (lambda c: (F.length(c) % 2).cast("string")) if weak else F.md5
    got = Counter(tuple(r) for r in exact_dedup(odd, keep=keep, content_hash=how).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == brute([tuple(r) for r in odd.select("doc_id", "text").collect()], {"smallest": min, "largest": max}[keep])


def test_a_hot_group_stays_whole(spark):
    docs = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, 'Hot', concat('t', id)) text")
    got = exact_dedup(docs, keep="largest").where("group_size > 1").agg(
        F.count(F.lit(1)), F.sum(F.col("kept").cast("int")), F.max("keep_id")).first()
    assert tuple(got) == (1000, 1, 2997)


def test_only_ascii_letters_are_lowered(documents):
    got = {r.doc_id: r.group_size for r in exact_dedup(documents([(1, "É A"), (2, "é A"), (3, "É a")])).collect()}
    assert got == {1: 2, 2: 1, 3: 2}


def test_empty_table(documents):
    assert exact_dedup(documents([])).collect() == []
