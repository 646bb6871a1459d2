"""Scans and sinks: SDMX, delimiter sniffing, whitelisted CSV union, JSON records,
fallback row, estimates source preference, the same-path overwrite guard and
round trips through a fresh folder."""

import json

import pytest
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens import sinks as SK
from pricelens.sources import readers as R
from pricelens.sources import sdmx as SD


def sdmx_doc(values, periods, time_id="TIME_PERIOD"):
    return json.dumps({"data": {
        "dataSets": [{"series": {"0:0": {"observations": values}}}],
        "structure": {"dimensions": {"observation": [
            {"id": "FREQ", "values": [{"id": "D"}]},
            {"id": time_id, "values": [{"id": p} for p in periods]}]}}}})


def test_sdmx_parse_skips_null_and_out_of_range(spark):
    docs = spark.createDataFrame([
        (sdmx_doc({"0": [3.4], "1": [None], "2": [3.6], "5": [9.9]}, ["2024-11-01", "2024-11-02", "2024-11-03"]),
         "ESTR", "ECB"),
        (sdmx_doc({"0": [1.0]}, ["2024-11-01"], time_id="OTHER"), "ESTR", "ECB"),
        ("{not json", "ESTR", "ECB"),
    ], ["json", "rate_type", "source"])
    rows = sorted(tuple(r) for r in R.parse_sdmx(docs).collect())
    assert rows == [("2024-11-01", 3.4, "ESTR", "ECB"), ("2024-11-03", 3.6, "ESTR", "ECB")]


def test_sdmx_pack_parse_round_trip(spark):
    obs = spark.createDataFrame([(f"p{i}", float(i), "T", "s", i) for i in range(600)],
                                "period string, rate_value double, rate_type string, source string, event_id long")
    obs = obs.unionByName(obs.filter("event_id < 300"))  # copies of half the ids
    docs = SD.pack_sdmx(obs, doc_size=256)
    sizes = [r.n for r in docs.select(F.size(F.json_object_keys(F.get_json_object(
        "json", "$.data.dataSets[0].series.0:0:0.observations"))).alias("n")).collect()]
    assert max(sizes) <= 256 + 2 and sum(sizes) == 900 + 2 * len(sizes)
    back = sorted((r.date, r.rate_value) for r in R.parse_sdmx(docs).collect())
    assert back == sorted([(f"p{i}", float(i)) for i in range(600)] + [(f"p{i}", float(i)) for i in range(300)])


def test_delimiter_detection(spark, tmp_out):
    p = tmp_out + "/rents"
    df = spark.createDataFrame([("01001", "15,8", "12,5"), ("01002", "9,1", None)],
                               ["code_commune", "loyer_m2_appartement", "loyer_m2_maison"])
    SK.land_csv(df, p, "2024-12-01", sep=";")
    assert R.detect_delimiter(spark, p) == ";"
    back = R.read_landed_csv(spark, p, sep=R.detect_delimiter(spark, p))
    assert sorted(back.columns) == ["code_commune", "ingestion_date", "loyer_m2_appartement", "loyer_m2_maison"]
    assert back.count() == 2
    p2 = tmp_out + "/commas"
    SK.land_csv(spark.createDataFrame([("a", "b")], ["x", "y"]), p2, "2024-12-01")
    assert R.detect_delimiter(spark, p2) == ","


def test_whitelisted_union_by_name(spark, tmp_out):
    a = spark.createDataFrame([("2024-01-01", "100", "x")], ["date_mutation", "valeur_fonciere", "other"])
    b = spark.createDataFrame([("7", "2024-02-02")], ["type_local", "date_mutation"])
    a.write.option("header", True).option("sep", "|").csv(tmp_out + "/a")
    b.write.option("header", True).option("sep", "|").csv(tmp_out + "/b")
    u = R.read_whitelisted_csv(spark, [tmp_out + "/a", tmp_out + "/missing", tmp_out + "/b"], sep="|")
    assert "other" not in u.columns
    rows = sorted((r.date_mutation, r.valeur_fonciere, r.type_local) for r in u.collect())
    assert rows == [("2024-01-01", "100", None), ("2024-02-02", None, "7")]
    with pytest.raises(Exception):
        R.read_whitelisted_csv(spark, [tmp_out + "/missing"], sep="|", tolerant=False)


def test_whitelisted_wrong_delimiter_raises(spark, tmp_out):
    spark.createDataFrame([("a", "b")], ["date_mutation", "type_local"]).write.option(
        "header", True).option("sep", "|").csv(tmp_out + "/c")
    with pytest.raises(ValueError):
        R.read_whitelisted_csv(spark, [tmp_out + "/c"], sep=",")


def test_json_records_array_and_lines(spark, tmp_out):
    arr = tmp_out + "/arr.json"
    with open(arr, "w") as fh:
        json.dump([{"date": "2024-11-20", "rate_value": 3.4, "rate_type": "ESTR", "source": "ECB"},
                   {"date": "2024-11-21", "rate_type": "ESTR"}], fh, indent=2)
    rows = R.read_json_records(spark, arr, C.RAW_RATES, multiline=True).collect()
    assert [(r.date, r.rate_value) for r in rows] == [("2024-11-20", 3.4), ("2024-11-21", None)]
    lines = tmp_out + "/lines"
    SK.land_json(spark.createDataFrame(rows), lines, "2024-12-01")
    back = R.read_json_records(spark, lines, C.RAW_RATES, multiline=False)
    assert back.count() == 2


def test_fallback_row(spark):
    empty = spark.createDataFrame([], C.RAW_RATES)
    rows = R.with_fallback_row(empty, "2024-12-01", 3.9, "ESTR", "ECB Data Portal").collect()
    assert [tuple(r) for r in rows] == [("2024-12-01", 3.9, "ESTR", "ECB Data Portal (fallback)")]
    full = spark.createDataFrame([("2024-11-20", 3.4, "ESTR", "ECB")], C.RAW_RATES)
    rows = R.with_fallback_row(full, "2024-12-01", 3.9, "ESTR", "ECB").collect()
    assert [tuple(r) for r in rows] == [("2024-11-20", 3.4, "ESTR", "ECB")]


def test_estimates_source_preference(spark, tmp_out):
    js = tmp_out + "/data.json"
    with open(js, "w") as fh:
        fh.write(json.dumps({"commune_code": "01001", "transaction_count": 5,
                             "computation_date": "2024-12-31"}) + "\n")
    df = R.read_estimates(spark, tmp_out + "/no-parquet", js)
    r = df.first()
    assert r.commune_code == "01001" and r.transaction_count == 5
    with pytest.raises(FileNotFoundError):
        R.read_estimates(spark, tmp_out + "/no-parquet", None)


def test_parquet_sink_partitions_and_guard(spark, tmp_out):
    p = tmp_out + "/est"
    df = spark.createDataFrame([("01001", "2024-12-31"), ("01002", "2024-12-30")], ["commune_code", "d"]) \
        .withColumn("computation_date", F.col("d").cast("date")).drop("d")
    assert SK.write_parquet(df, p, partition_by=["computation_date"]) == 2
    back = spark.read.parquet(p)
    assert dict(back.dtypes)["computation_date"] == "date"
    with pytest.raises(ValueError):
        SK.write_parquet(back.filter(F.col("commune_code") == "01001"), p, partition_by=["computation_date"])
    assert back.count() == 2  # the guarded write left the data in place


def test_dynamic_overwrite_keeps_other_runs(spark, tmp_out):
    p = tmp_out + "/runs"
    mk = lambda code, d: spark.createDataFrame([(code, d)], ["commune_code", "d"]).withColumn(
        "computation_date", F.col("d").cast("date")).drop("d")
    SK.write_parquet(mk("01001", "2024-12-30"), p, partition_by=["computation_date"])
    SK.write_parquet(mk("01002", "2024-12-31"), p, partition_by=["computation_date"], dynamic=True)
    assert spark.read.parquet(p).count() == 2


def test_documents_drop_nulls_and_iso_dates(spark, tmp_out):
    df = spark.createDataFrame([("01001", None)], "commune_code string, rent_m2 double") \
        .withColumn("computation_date", F.lit("2024-12-31").cast("date"))
    doc = SK.documents(df).first()
    assert doc._index == SK.DEFAULT_INDEX
    assert json.loads(doc._source) == {"commune_code": "01001", "computation_date": "2024-12-31"}
    assert SK.write_documents(df, tmp_out + "/docs") == 1
    line = spark.read.text(tmp_out + "/docs").first().value
    assert json.loads(line) == {"_index": SK.DEFAULT_INDEX,
                                "_source": {"commune_code": "01001", "computation_date": "2024-12-31"}}


def test_header_normalisation_and_contracts(spark):
    df = spark.createDataFrame([(1, 2)], [" A ", "b"])
    assert R.normalize_headers(df).columns == ["a", "b"]
    est = spark.createDataFrame([("01001", "BAD")], ["commune_code", "fair_price_confidence"])
    missing = C.missing_columns(est, C.ESTIMATES)
    assert "commune_name" in missing and "commune_code" not in missing
    assert est.filter(C.confidence_violation()).count() == 1
    conformed = C.conform(est, C.ESTIMATES)
    assert conformed.columns == list(C.ESTIMATE_COLUMNS)


def test_read_csv_detected_per_file(spark, tmp_out):
    p = tmp_out + "/rents"
    a = spark.createDataFrame([("01001", "15,8")], ["code_commune", "loyer_m2_appartement"])
    b = spark.createDataFrame([("01002", "12.5")], ["code_commune", "loyer_m2_appartement"])
    SK.land_csv(a, p, "2024-12-30", sep=";")
    SK.land_csv(b, p, "2024-12-31", sep=",")
    rows = sorted((r.code_commune, r.loyer_m2_appartement, str(r.ingestion_date))
                  for r in R.read_csv_detected(spark, p).collect())
    assert rows == [("01001", "15,8", "2024-12-30"), ("01002", "12.5", "2024-12-31")]
    latest = R.read_csv_detected(spark, p, snapshot="latest").collect()
    assert [r.code_commune for r in latest] == ["01002"]


def test_detected_columns_go_by_each_files_header(spark, tmp_out):
    p = tmp_out + "/rents"
    files = [("2024-12-29", 'code_commune;"loyer";annee', ["01001;15,8;2023", "", '01002;"a;b"', "01003;;2024;surplus"]),
             ("2024-12-30", "ANNEE,code_commune", ["2022,02001"]), ("2024-12-31", "code_commune,,loyer", ["03001,x,7.5"])]
    for day, header, lines in files:
        spark.createDataFrame([(x,) for x in [header, *lines]], "value string").coalesce(1).write.text(f"{p}/ingestion_date={day}")
    got = R.read_csv_detected(spark, p)
    assert {c.lower() for c in got.columns} == {"code_commune", "loyer", "annee", "_c1", "ingestion_date"}
    assert dict(got.dtypes)["ingestion_date"] == "date"
    rows = {(r.code_commune, r.loyer, r._c1, r["annee"], str(r.ingestion_date)) for r in got.withColumnRenamed("ANNEE", "annee").collect()}
    assert rows == {("01001", "15,8", None, "2023", "2024-12-29"), ("01002", "a;b", None, None, "2024-12-29"),
                    ("01003", None, None, "2024", "2024-12-29"), ("02001", None, None, "2022", "2024-12-30"),
                    ("03001", "7.5", "x", None, "2024-12-31")}


def test_landed_text_is_scanned_once(spark, tmp_out):
    """Delimiters, headers and rows come from the written lines; the landing's files are in none of their plans."""
    p = tmp_out + "/rents"
    SK.land_csv(spark.createDataFrame([("01001", "15,8")], ["code_commune", "loyer"]), p, "2024-12-30", sep=";")
    lines = R.landed_lines(spark, p)
    sales, _ = R.read_quarantined_csv(spark, [p], ["code_commune"], sep=";")
    for df in (lines, R.delimiter_counts(lines), R.read_csv_detected(spark, p, lines=lines), sales):
        assert df.count() and not [f for f in df.inputFiles() if "/rents/" in f]


def test_conform_casts_fills_and_drops(spark):
    df = spark.createDataFrame([("01001", "12", "x", "2024-12-31")],
                               ["commune_code", "transaction_count", "extra", "computation_date"])
    out = C.conform(df, C.ESTIMATES)
    assert out.columns == list(C.ESTIMATE_COLUMNS)
    r = out.first()
    assert r.transaction_count == 12 and r.median_price_m2 is None
    assert str(r.computation_date) == "2024-12-31"
    bad = C.conform(spark.createDataFrame([("abc",)], ["transaction_count"]), C.ESTIMATES).first()
    assert bad.transaction_count is None  # malformed -> NULL, not an error


def test_sdmx_edge_cases(spark):
    docs = spark.createDataFrame([
        # two series, one without observations, one with an empty value list and a bad index
        (json.dumps({"data": {
            "dataSets": [{"series": {"0:0": {"observations": {"0": [2.5], "1": [], "x": [9.0]}},
                                     "0:1": {}}}],
            "structure": {"dimensions": {"observation": [
                {"id": "TIME_PERIOD", "values": [{"id": "2024-01-01"}, {"id": "2024-01-02"}]}]}}}}),
         "ESTR", "ECB"),
        # no dataSets at all
        (json.dumps({"data": {"structure": {"dimensions": {"observation": [
            {"id": "TIME_PERIOD", "values": [{"id": "2024-01-01"}]}]}}}}), "ESTR", "ECB"),
        (None, "ESTR", "ECB"),
    ], "json string, rate_type string, source string")
    rows = [tuple(r) for r in R.parse_sdmx(docs).collect()]
    assert rows == [("2024-01-01", 2.5, "ESTR", "ECB")]


def test_whitelisted_files_of_one_folder_keep_their_own_headers(spark, tmp_out):
    folder = tmp_out + "/dvf"
    for header, row in (("code_commune|nom_commune", "75056|Paris"), ("nom_commune|code_commune|x", "Nantes|44109|1"), ("odd|headers", "a|b")):
        spark.createDataFrame([(header,), (row,)], "value string").coalesce(1).write.mode("append").text(folder)
    skipped = []
    got = R.read_whitelisted_csv(spark, [folder, tmp_out + "/none"], skipped=skipped)
    assert {(r.code_commune, r.nom_commune) for r in got.collect()} == {("75056", "Paris"), ("44109", "Nantes")}
    assert len(skipped) == 2 and tmp_out + "/none" in skipped
    with pytest.raises(FileNotFoundError):
        R.read_whitelisted_csv(spark, [tmp_out + "/none"], tolerant=False)


def test_json_arrays_are_told_by_their_first_line(spark, tmp_out):
    for name, text in (("a", '\n[\n {"date": "2024-01-01",\n  "rate_value": 1.5}\n]'), ("l", '{"date": "2024-01-01", "rate_value": 1.5}\n{"date": "2024-01-02"}')):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{tmp_out}/{name}")
    assert [r.rate_value for r in R.read_json_records(spark, tmp_out + "/a").collect()] == [1.5]
    assert R.read_json_records(spark, tmp_out + "/l").count() == 2


def test_guard_compares_roots(spark, tmp_out):
    spark.range(3).write.parquet(tmp_out + "/t/part")
    df = spark.read.parquet(tmp_out + "/t/part")
    for target in ("/t", "/t/part", "/t/part/sub"):
        with pytest.raises(ValueError):
            SK.guard_not_input(df, tmp_out + target)
    SK.guard_not_input(df, tmp_out + "/t/part2")
