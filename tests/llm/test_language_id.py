"""Language identification: phrases against plain substring search, folds, odd rows, held-out accuracy."""

import random
import zlib

import pytest
import regex
from pyspark.sql import functions as F

from pricelens.llm.language_id import Automaton, automata, identify, identify_languages, learn, normalised, sample


def phrases_by_search(text, known):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i:i + k + 1] in known:
            k += 1
        i += k
        n += 1
    return n


@pytest.mark.parametrize("seed", range(40))
def test_phrases_are_longest_matches(seed):
    r = random.Random(seed)
    known = "".join(r.choice("ab cé"[:r.randint(1, 5)]) for _ in range(r.randint(1, 80))).encode()
    texts = ["".join(r.choice("ab cxéß") for _ in range(r.randint(0, 200))).encode() for _ in range(r.choice([0, 3, 100]))]
    assert Automaton(known).count_phrases(texts).tolist() == [phrases_by_search(t, known) for t in texts]


def test_all_bytes():
    known = bytes(range(256)) * 2
    assert Automaton(known).count_phrases([known, known[::-1], b""]).tolist() == [1, phrases_by_search(known[::-1], known), 0]


def has_letter(text):
    return regex.search(r"\p{L}", text) is not None


def test_normalised():
    for t in ["Ab3c--Dé\n\nx", "x", "--x", "x--", "１x２", "नमस्ते दुनिया 12", "日本語。テキスト", "A\x00B\u2028C"]:
        assert normalised(t).decode() == regex.sub(r"[^\p{L}\p{M}]+", " ", t.lower())
    assert normalised("12 ½ _-") == normalised("") == b""


def test_ties_go_to_the_least_language():
    known = automata({"b": b"same text", "a": b"same text"})
    assert identify(["same"], known, 3.0) == [("a", 0.5, 1 / 4)]


LANGS = {"xx": "foo bar baz qux", "yy": "lorem ipsum dolor sit"}


def _labelled(spark, n=400):
    rows = []
    r = random.Random(1)
    for i in range(n):
        lang = "xx" if i % 2 else "yy"
        rows.append((i, " ".join(r.choice(LANGS[lang].split()) for _ in range(30)), lang, "s", "clash"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string")


def test_learns_only_from_rows_not_held_out(spark):
    docs = _labelled(spark).withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "secret").otherwise(
        F.col("lang")))
    assert set(learn(docs)) == {"xx", "yy"}
    got = identify_languages(docs, learn(docs)).collect()
    assert len(got) == 400
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["lang_pred"] == ("xx" if r["doc_id"] % 2 else "yy") and 0.5 < r["score"] <= 1


def test_sample_is_bounded_and_repeatable(spark):
    docs = _labelled(spark).unionByName(_labelled(spark))  # every id twice
    one = sample(docs, 5, 20).collect()
    assert sorted(one) == sorted(sample(docs.repartition(7), 5, 20).collect())
    assert all(len(r["piece"]) <= 20 and r["n"] <= 5 for r in one) and len(one) == 10
    with pytest.raises(ValueError):
        learn(docs, max_languages=1)


def test_odd_rows(spark, odd):
    samples = {k: v.encode() for k, v in LANGS.items()}
    got = identify_languages(odd, samples)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == odd.count()
    texts = {(r["doc_id"], r["text"]) for r in odd.collect()}
    for r in rows:
        kinds = {bool(t) and has_letter(t) for i, t in texts if i == r["doc_id"]}
        if kinds == {False}:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"xx", "yy", "und"}
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False, False]
    assert identify_languages(odd.limit(0), samples).count() == 0
    assert {r["lang_pred"] for r in identify_languages(odd, {}).collect()} == {"und"}
    assert learn(odd) == {}  # no row has a language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs, learn(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out and lang_pred <> 'und'")
    assert held.where("lang_pred = lang").count() >= 0.97 * held.count() > 200
