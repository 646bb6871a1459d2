"""Rules in one aggregate, audited versions, quarantined files, rates by file form, the ledger's invariant."""

import pytest
from pyspark.sql import functions as F

from pricelens import quality as Q
from pricelens import sinks as SK
from pricelens.plans import daily as P
from pricelens.plans import landing as L
from pricelens.sources import readers as R


def test_check_counts_and_examples(spark):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 10 != 0, F.col("id")))
    rules = {"big": F.col("v") > 990, "none": F.col("v") < 0, "null": F.col("v").isNull()}
    got = {r.rule: r for r in Q.check(df, rules, ["id"], examples=4).collect()}
    assert got["big"].n_violations == 9 and got["none"].n_violations == 0 and got["null"].n_violations == 100
    assert got["none"].examples == [] and 1 <= len(got["null"].examples) <= 4
    assert set(got["big"].examples) <= {f'{{"id":{i}}}' for i in range(991, 1000)}
    plan = Q.check(df, rules, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Range") == 1
    assert {r.n_violations for r in Q.check(df.limit(0), rules, ["id"]).collect()} == {0}


def test_only_audited_versions_are_seen(spark, tmp_out):
    root, rules = tmp_out + "/t", {"small": F.col("id") > 100}
    with pytest.raises(FileNotFoundError):
        Q.read_published(spark, root)
    assert Q.publish(spark.range(10), root, "a", rules, ["id"]) == 10
    with pytest.raises(Q.AuditFailed) as failed:
        Q.publish(spark.range(200), root, "b", rules, ["id"])
    assert failed.value.broken["small"][0] == 99
    with pytest.raises(Q.AuditFailed, match="row_count"):
        Q.publish(spark.range(0), root, "c", rules, ["id"])
    assert Q.read_published(spark, root).count() == 10
    assert Q.publish(spark.range(20), root, "b", rules, ["id"]) == 20  # the rejected version, mended
    assert Q.read_published(spark, root).count() == 20
    with pytest.raises(ValueError, match="is published"):
        Q.publish(spark.range(5), root, "a", rules, ["id"])


def put(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_bad_files_are_left_out_whole(spark, tmp_out):
    d = tmp_out + "/dvf"
    put(d, "good.txt", '﻿code_commune|nom_commune|z\r\n44109|"Nantes|x"|1\r\n\r\n75056|Paris\r\n')
    put(d, "other.txt", "nom_commune|code_commune\nLyon|69123\nnom_commune|code_commune\n")
    put(d, "wide.txt", "code_commune|nom_commune\n1|a\n\n2|b|surplus\n3|c\n4|d|e|f\n")
    put(d, "bytes.txt", b"code_commune|nom_commune\n1|a\n2|\xff\xfe\n")
    put(d, "odd.txt", "x|y\n1|2\n")
    put(d, "empty.txt", "")
    skipped = []
    rows, rejects = R.read_quarantined_csv(spark, [d, tmp_out + "/none"], skipped=skipped)
    assert {(r.code_commune, r.nom_commune) for r in rows.collect()} == {("44109", "Nantes|x"), ("75056", "Paris"), ("69123", "Lyon")}
    got = {(r.file.split("/")[-1], r.line, r.reason) for r in rejects.collect()}
    assert got == {("wide.txt", 4, R.BAD_FIELDS), ("wide.txt", 6, R.BAD_FIELDS), ("bytes.txt", 3, R.BAD_TEXT), ("odd.txt", 1, R.BAD_HEADER)}
    assert len(skipped) == 4
    with pytest.raises(ValueError):
        R.read_quarantined_csv(spark, [d], tolerant=False)


def test_good_files_land_beside_a_broken_one(spark, tmp_out):
    d = tmp_out + "/dvf"
    put(d, "44.txt", "date_mutation|valeur_fonciere\n2024-01-01|1\n")
    put(d, "75.txt", "date_mutation|valeur_fonciere\n2024-01-01|1|2\n")
    skipped = []
    assert L.land_sales(spark, [d], tmp_out + "/raw", "2024-12-31", skipped=skipped) == 1 and len(skipped) == 1
    assert R.read_landed_csv(spark, tmp_out + "/raw/dvf").count() == 1
    assert [r.line for r in spark.read.json(tmp_out + "/raw/rejects/dvf").collect()] == [2]


def test_rates_of_both_forms_land_whole(spark, tmp_out):
    d = tmp_out + "/rates"
    put(d + "/ingestion_date=2024-12-30", "a.json", '{"date": "2024-01-01", "rate_value": 1.5}\n{"date": "2024-01-02", "ra\n\n{"date": "2024-01-03"}\n')
    put(d + "/ingestion_date=2024-12-31", "b.json", '\n [\n {"date": "2024-01-04",\n  "rate_value": 2.5}\n]')
    put(d + "/ingestion_date=2024-12-31", "c.json", '[{"date": "2024-01-05"')
    put(d + "/ingestion_date=2024-12-31", "blank.json", "\n \n")
    rows = R.read_json_records(spark, d, corrupt="bad")
    assert {r.date for r in rows.collect() if r.bad is None} == {"2024-01-01", "2024-01-03", "2024-01-04"}
    assert R.count_unreadable(rows, "bad").first()[0] == 2
    assert {str(r.ingestion_date) for r in rows.collect()} == {"2024-12-30", "2024-12-31"}


def test_documents_of_several_series_land_together(spark, tmp_out):
    from tests.test_sources_sinks import sdmx_doc
    for kind, value in (("ESTR", 3.0), ("EURIBOR", 4.0)):
        put(f"{tmp_out}/pub/{kind}", "1.json", sdmx_doc({"0": [value]}, ["2024-01-01"]))
    paths = {k: f"{tmp_out}/pub/{k}" for k in ("ESTR", "EURIBOR")}
    assert L.land_rates(spark, paths, tmp_out + "/raw", "2024-12-31") == 2
    got = R.read_json_records(spark, tmp_out + "/raw/rates").collect()
    assert {(r.rate_type, r.rate_value) for r in got} == {("ESTR", 3.0), ("EURIBOR", 4.0)}


def test_the_ledger_must_balance(spark, tmp_out):
    with pytest.raises(RuntimeError, match="not conserved"):
        P._write_ledger(spark, tmp_out + "/l", "2024-12-31", {"raw_sales": 5, "formatted_sales": 3, "rejected_sales:x": 1})
    class Lost:
        get = {}

    with pytest.raises(RuntimeError, match="lost"):
        SK.rows_of(Lost())
