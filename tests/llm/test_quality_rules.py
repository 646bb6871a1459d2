import re
from collections import Counter

import pytest

from pricelens.llm.quality_rules import measured, quality_rules
from pricelens.session import sf_table

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.mark.parametrize("bits", [24, 60, 3])
def test_counts_are_those_of_brute_force(spark, odd, bits):
    # 60 position bits leave 4 of the hash (collisions); 3 make nearly every text too long for the fast path.
    extra = odd.unionByName(sf_table(spark, SF, "documents").selectExpr(
        "doc_id + 100 doc_id", "text", "lang", "'r' row", "0L h", "'' kept", "'' score"))
    got = measured(extra, position_bits=bits).collect()
    want = [(r.doc_id, *brute(r.text)) for r in extra.select("doc_id", "text").collect()]
    assert Counter((r.doc_id, *(r[n] for n in NAMES)) for r in got) == Counter(want)


def test_verdict(documents):
    good = " ".join(f"the wood{i} of word{i} and" for i in range(20))
    docs = documents([(1, good), (2, None), (3, "** " * 30 + good), (4, "Und " * 90), (5, good.upper()),
                      (6, " ".join(f"wood{i}" for i in range(90)))])
    got = {r.doc_id: (r.kept, r.base_failed, set(r.failed)) for r in quality_rules(docs).collect()}
    assert got[1] == (True, False, set())
    assert got[2][:2] == (False, True)
    assert "symbols" in got[3][2] and not got[3][1]
    assert got[4][:2] == (False, True) and "repeated_words" in got[4][2]
    assert got[5][2] == {"upper_case"}
    assert got[6][2] == {"stop_words"}


def test_stop_words_are_asked_of_listed_languages_only(documents):
    russian = " ".join(f"слово{'абвгдежзик'[i % 10]}{'лмнопрстуф'[i // 10]} дом" for i in range(60))
    polish = " ".join(f"żółw{'abcdefghij'[i % 10]}{'klmnoprstu'[i // 10]} łąka" for i in range(60))
    mixed = " ".join(f"wood{i} слово{i}" if i == 0 else f"wood{i} word{i}" for i in range(90))
    got = {r.doc_id: (r.kept, r.failed) for r in quality_rules(documents([(1, russian), (2, polish), (3, mixed)])).collect()}
    assert got[1] == (True, []) and got[2] == (True, []) and got[3] == (False, ["stop_words"])


def test_rows_are_carried_whole_and_a_filter_does_not_repeat_the_counts(documents):
    docs = documents([(1, "a b"), (None, None)])
    out = quality_rules(docs, carry=True)
    assert sorted(map(str, out.select("row.*").collect())) == sorted(map(str, docs.collect()))
    plan = out.where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") <= 2


def test_empty_table(documents):
    assert quality_rules(documents([])).collect() == []
