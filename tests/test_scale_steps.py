"""Steps that every row goes through: what they do per row, and that they gather no more than they must."""

import os
import re

from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens.functions import exprs as X
from pricelens.operators import formatting as FMT
from pricelens.plans import queries as Q
from pricelens.sources import readers as R
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dates_are_cast_and_only_odd_ones_meet_the_formatter(spark):
    texts = ["2024-02-29", "2023-02-29", "2024-1-1", "2024-01-01 ", " 2024-01-1", "0000-01-01", "0001-01-01", "9999-12-31", "10000-01-01",
             "+2024-01-1", "-001-01-01", "2024-01-01T00", "15/03/2024", "2024-13-01", "", "1582-10-10", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    new, old = X.strict_date("t"), F.try_to_date("t", "yyyy-MM-dd")
    assert df.where(~new.eqNullSafe(old)).collect() == []
    assert df.where(new.isNotNull()).count() >= 4
    assert "CASE WHEN" in plan_of(df.select(new))


def test_plain_paths_are_not_decoded(spark, tmp_out):
    for i, name in enumerate(["plain", "a b", "a+b", "a%20b", "é"]):
        os.makedirs(f"{tmp_out}/landed/{name}")
        with open(f"{tmp_out}/landed/{name}/f.csv", "w") as f:
            f.write(f"x\n{i}\n")
    listed = R.landed_files(spark, f"{tmp_out}/landed/*")
    read = R.with_file(spark.read.option("header", True).csv(f"{tmp_out}/landed/*"))
    assert {r["_file"] for r in read.collect()} == {r["file"] for r in listed.collect()} and listed.count() == 5
    assert "CASE WHEN" in plan_of(read)


def test_distinct_sales_are_found_before_their_ids_are_made(spark):
    row = ("2024-01-02", "100,5", "MAISON", "10", "2", "1001", "A", "1")
    other = ("2024-01-02", "100,5", "maison", "10,0", "2.0", "01001", "A", "1")
    raw = spark.createDataFrame([row, row, other, (*row[:4], "3", *row[5:])], ", ".join(f"{c} string" for c in C.RAW_SALES_COLUMNS))
    out = FMT.format_sales(raw, dedup=True)
    assert sorted(map(str, out.collect())) == sorted(map(str, FMT.format_sales(raw).distinct().collect())) and out.count() == 2
    keys = re.findall(r"keys=\[([^\]]*)\]", plan_of(out))
    assert keys and not any("sale_id" in k or "year" in k for k in keys)


def test_verdicts_sort_no_lines(spark, tmp_out):
    with open(f"{tmp_out}/a.csv", "w") as f:
        f.write("\n  \ncode_commune|x\n1|2\n1|2|3\n")
    lines = R._text_lines(spark, tmp_out, "|")
    verdicts = R.file_verdicts(lines, R.SALES_WHITELIST, "|")
    assert "Sort" not in plan_of(verdicts)
    got = verdicts.collect()
    assert [(r["header"], r["n_header"], r["reason"]) for r in got] == [(["code_commune", "x"], 2, R.BAD_FIELDS)]


def test_department_files_are_written_without_a_sort(spark, monkeypatch):
    seen = []
    land = R.read_quarantined_csv
    monkeypatch.setattr(R, "read_quarantined_csv", lambda s, paths, *a, **k: seen.extend(paths) or land(s, paths, *a, **k))
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    put = []
    conf = type(spark.conf)
    real = conf.set
    monkeypatch.setattr(conf, "set", lambda self, k, v: put.append((k, v)) or real(self, k, v))
    before = spark.conf.get(setting)
    assert Q.sales_quarantine(spark, SF_SMALL).count() > 0
    assert (setting, str(Q.OPEN_WRITERS)) in put and spark.conf.get(setting) == before
    for folder in os.listdir(seen[0]):
        if folder.startswith("department="):  # a file for each department
            assert len([f for f in os.listdir(f"{seen[0]}/{folder}") if f.endswith(".csv")]) == 1
