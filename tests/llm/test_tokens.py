import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricelens.llm import bpe, token_counts
from pricelens.llm.bpe import DIGESTS, encode_decode, merge_long, merges
from pricelens.llm.common import new_path
from pricelens.llm.tokens import JsonEncoder, encoder, read_ranks
from pricelens.session import sf_table

SF = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
HARD = ["", " ", "hi<|endoftext|> <|endoftext|>x <|endoftext", "don't WE'LL  \n\n\t x", "日本語 テキスト 🏳️‍🌈", "é́ 　x​\x85 y\x1c ٣٤ Ⅷ½",
        "a" * 3000, "\n" * 5000 + "a", "ab" * 900, "\x00\x01", "ñ" * 300]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


def test_json_encoder_gives_the_librarys_ids(spark):
    own, library = JsonEncoder(JSON), Tokenizer.from_file(JSON)
    assert own.fast is not None
    texts = HARD + [r.text or "" for r in sf_table(spark, SF, "documents").select("text").collect()]
    for t in texts:
        ids = own.ids(t)
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids
        assert own.decode(ids) == t
    assert len(own.ids("\n" * 2_000_000 + "a")) > 1  # beyond the fast engine's stack


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_go_through_their_library(name):
    path = public_tokenizers.path(name)
    for t in HARD[:6]:
        want = (sentencepiece.SentencePieceProcessor(model_file=path).encode(t) if name.endswith(".model")
                else Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids)
        assert encoder(path).ids(t).tolist() == want


def test_every_token_comes_from_merges_of_lower_rank():
    ranks = read_ranks(RANKS)
    assert len(merges(ranks)) == len(ranks) - 256
    with pytest.raises(ValueError):
        merges({b"a": 0, b"b": 1, b"c": 2, b"abc": 3})


def test_long_words_merge_as_in_the_library(library):
    r = random.Random(0)
    ranks = read_ranks(RANKS)
    for n in (1, 2, 3, 50, 700):
        for letters in ("ab", "etaoin shr", "éñ日x"):
            word = "".join(r.choice(letters) for _ in range(n)).encode()
            assert merge_long(word, ranks) == library._encode_single_piece(word)


@pytest.mark.parametrize("words", [bpe.WORDS, 50])
@pytest.mark.parametrize("folded", [bpe.FOLDED, 4])
def test_encoding_is_the_librarys_and_decoding_returns_the_text(spark, odd, library, monkeypatch, words, folded):
    monkeypatch.setattr(bpe, "WORDS", words)
    monkeypatch.setattr(bpe, "GROUP_BYTES", 4000 if words == 50 else bpe.GROUP_BYTES)
    rows = [(100 + i, t) for i, t in enumerate(HARD)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")).where(
        (F.length("text") < 20_000) | F.col("text").isNull()).repartition(2)
    got = Counter(tuple(r) for r in encode_decode(docs, RANKS, public_tokenizers.PATTERN, folded=folded, each=DIGESTS).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    want = Counter()
    for i, t in docs.collect():
        ids = np.array(library.encode_ordinary(t or ""), dtype="<u4")
        want[(i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert got == want


def test_fast_splitting_finds_the_patterns_matches(spark):
    whole, fast = regex.compile(public_tokenizers.PATTERN).findall, bpe.splitter(public_tokenizers.PATTERN)
    r = random.Random(0)
    texts = HARD + [x.text or "" for x in sf_table(spark, SF, "documents").select("text").collect()]
    texts += ["".join(r.choice("aZé ÿŞ09_'stlmdreve\n\t\x0b\x1c\x1f\x85\xa0ªµ×÷!$|") for _ in range(r.randint(0, 30))) for _ in range(20_000)]
    texts += [chr(c) + "a" + chr(c) + "1 " + chr(c) for c in range(0x250)]
    for t in texts:
        assert fast(t) == whole(t), repr(t)


def test_whole_results(documents, library):
    got = encode_decode(documents([(1, "two words"), (2, None)]), RANKS, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    assert [(np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got] == [(library.encode("two words"), b"two words"), ([], b"")]


def test_encoding_an_empty_table(documents):
    assert encode_decode(documents([]), RANKS, public_tokenizers.PATTERN).collect() == []


def counts(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())


def test_counts_and_the_cache(spark, odd, documents):
    path = new_path(spark, "cache")
    library = Tokenizer.from_file(JSON)
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]

    def want(rows):
        n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
        return Counter((i, len((t or "").encode()), k, k > 1024) for (i, t), k in zip(rows, n, strict=True))

    assert counts(token_counts.token_counts(odd, JSON, path)) == want(rows)
    assert spark.read.parquet(path).count() == len({t or "" for _, t in rows})  # every distinct text once
    # Known texts are not encoded again; new ones are appended.
    more = [(1, "one"), (2, "never seen"), (3, "never seen")]
    assert counts(token_counts.token_counts(documents(more), JSON, path)) == want(more)
    assert spark.read.parquet(path).count() == len({t or "" for _, t in rows}) + 1


def test_a_stored_count_is_used_and_another_version_is_not(spark, documents):
    path = new_path(spark, "cache")
    version = token_counts.version_digest(JSON)
    known = hashlib.sha256(b"one").hexdigest()
    spark.createDataFrame([(version, known, 77), ("other", hashlib.sha256(b"two").hexdigest(), 88)], token_counts.CACHE).write.parquet(path)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(documents([(1, "one"), (2, "two")]), JSON, path).collect()}
    assert got == {1: 77, 2: 1}


def test_counting_an_empty_table(spark, documents):
    assert token_counts.token_counts(documents([]), JSON, new_path(spark, "cache")).collect() == []


def test_very_long_texts_encode_as_in_the_library(documents, library):
    r = random.Random(2)
    words = ["".join(r.choice("etaoinshré日 ") for _ in range(r.randint(1, 12))) for _ in range(3000)]
    text = " ".join(r.choice(words) for _ in range(200_000))
    rows = [(1, text), (2, text[::-1]), (3, "x" * 1500 + text[:50_000]), (4, text)]
    got = {x.doc_id: (x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in encode_decode(
        documents(rows), RANKS, public_tokenizers.PATTERN, each=DIGESTS).collect()}
    for i, t in rows:
        ids = np.array(library.encode_ordinary(t), dtype="<u4")
        assert got[i] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_registered_queries_leave_the_session_and_use_the_cache(spark, monkeypatch):
    """op3 puts its batch size back; op9's second run meets hits and misses and encodes each text once."""
    from pricelens.llm import queries
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    queries.op3_bpe(spark, SF)
    assert spark.conf.get(setting) == before
    path = new_path(spark, "cache")
    monkeypatch.setattr(queries, "new_path", lambda *_: path)
    runs = []
    monkeypatch.setattr(queries, "token_counts", lambda *a, **k: runs.append(
        (spark.read.parquet(path).count() if runs else 0, token_counts.token_counts(*a, **k))) or runs[-1][1])
    got = queries.op9_token_counts(spark, SF)
    library = Tokenizer.from_file(JSON)
    rows = [(r.doc_id, r.text or "") for r in sf_table(spark, SF, "documents").select("doc_id", "text").collect()]
    n = [len(library.encode(t, add_special_tokens=False).ids) for _, t in rows]
    assert counts(got) == Counter((i, len(t.encode()), k, k > 1024) for (i, t), k in zip(rows, n, strict=True))
    distinct = len({t for _, t in rows})
    assert 0 < runs[1][0] < distinct == spark.read.parquet(path).count()
