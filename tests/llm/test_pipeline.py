"""The registered queries against their SQL, the pipeline against its stages by brute force."""

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from pricelens.session import sf_table

SF = "/root/testdata/sf0.001"
ORACLES = sorted(k for k in entry.oracle_sql() if k.startswith("op"))


def test_every_operator_is_registered():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    out = entry.queries()[name](spark, SF)
    cols = sorted(out.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert Counter(tuple(r[c] for c in cols) for r in out.collect()) == Counter(want)


def test_stages(spark, odd, documents):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "quality_classifier", "exact_dedup", "simhash_dedup", "pack"]
    docs = sf_table(spark, SF, "documents")
    for k, (_, stage) in enumerate(C.STAGES):
        for d in (docs, odd, documents([])):
            out = stage(spark, d, SF)
            assert k == 4 or out.columns == d.columns
            out.count()


def test_exact_and_near_stage_keep_one_of_each_group(spark, documents):
    base = " ".join(f"w{i}" for i in range(3000))
    docs = documents([(1, base), (2, base.upper()), (3, base + " end"), (4, "other text here"), (4, "other text here"), (None, "x"), (None, "x")])
    exact = C.exact_stage(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in exact.collect()) == ["2", "3", "4", "None"]
    assert sorted(str(r.doc_id) for r in C.near_stage(spark, exact, SF).collect()) == ["2", "4", "None"]


def test_rows_of_one_id_are_told_apart_by_their_texts(spark, documents):
    base = " ".join(f"w{i}" for i in range(3000))
    docs = documents([(5, "A"), (5, "B"), (9, "a"), (None, "b"), (None, "alone"), (3, base), (3, base + " end"),
                      (3, "far from it"), (3, "far from it"), (None, base + " End"), (6, base.upper())])
    exact = C.exact_stage(spark, docs, SF)
    want = [("3", base), ("3", "far from it"), ("3", base + " end"), ("5", "B"), ("6", base.upper()), ("9", "a"), ("None", "alone")]
    got = sorted((str(r.doc_id), r.text) for r in exact.collect())
    assert got == sorted(x for x in want if x != ("3", base))
    near = [(str(r.doc_id), r.text) for r in C.near_stage(spark, docs.where("length(text) > 1"), SF).collect()]
    assert Counter(i for i, _ in near) == {"3": 2, "None": 1}
    assert ("3", "far from it") in near and ("None", "alone") in near


def test_run_is_its_stages(spark):
    docs = sf_table(spark, SF, "documents")
    left = {r.doc_id: r.text for r in docs.collect()}
    for _, stage in C.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        rows = kept.collect()
        assert all(left[r.doc_id] == r.text for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
    want = Counter(r.doc_id for r in C.pack_stage(spark, docs, SF).collect())
    assert Counter(r.doc_id for r in C.run(spark, SF).collect()) == want


def test_the_rest_works_without_this_package():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = ("import sys, importlib.abc\n"
            "class No(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('pricelens.llm'): raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, No())\n"
            "import __spark_entry__ as e\n"
            "assert not [k for k in e.queries() if k.startswith('op') or k == 'pipeline'], list(e.queries())\n"
            "e.oracle_sql()\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
