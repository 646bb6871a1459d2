"""Regression tests for the survey's semantic decisions (Q-2, Q-4, Q-11, Q-13)."""

import datetime

from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens import sinks as SK
from pricelens.operators import formatting as FMT
from pricelens.operators import valuation as VAL
from pricelens.sources import readers as R

ROW = ("2024-03-15", "250000", "Appartement", "55", "3", "44109", "Nantes", "44")


def test_q2_unit_price_rounds_half_up_on_the_printed_decimal(spark):
    # 1.005 is stored as 1.00499999999999989...; Spark's round works on "1.005" -> 1.01.
    raw = spark.createDataFrame([ROW[:1] + ("1,005",) + ROW[2:3] + ("1",) + ROW[4:]], C.RAW_SALES)
    assert FMT.format_sales(raw).first().price_per_m2 == 1.01


def test_q4_latest_snapshot_only(spark, tmp_out):
    p = tmp_out + "/dvf"
    SK.land_csv(spark.createDataFrame([ROW], C.RAW_SALES), p, "2024-12-30")
    SK.land_csv(spark.createDataFrame([ROW, ROW], C.RAW_SALES), p, "2024-12-31")
    assert R.read_landed_csv(spark, p).count() == 3
    latest = R.read_landed_csv(spark, p, snapshot="latest")
    assert latest.count() == 2
    assert {r.ingestion_date for r in latest.collect()} == {datetime.date(2024, 12, 31)}


def test_q11_newest_estimate_pick_is_deterministic(spark):
    est = spark.createDataFrame(
        [("01001", "B", "1", "House", "1 room", 10, "2024-12-31"),
         ("01001", "A", "1", "House", "1 room", 10, "2024-12-31"),
         ("01001", "Z", "1", "House", "1 room", 50, "2024-12-30")],
        "commune_code string, commune_name string, department_code string, property_type string, "
        "rooms_bucket string, transaction_count long, d string").withColumn(
        "computation_date", F.col("d").cast("date")).drop("d")
    picks = {r.commune_name for r in VAL.latest_estimates(est.repartition(3)).collect()}
    assert picks == {"A"}


def test_q13_json_snapshot_keeps_leading_zeros(spark, tmp_out):
    p = tmp_out + "/snap.json"
    with open(p, "w") as fh:
        fh.write('{"commune_code": "01001", "transaction_count": 3}\n')
    r = R.read_estimates(spark, None, p).first()
    assert r.commune_code == "01001"


def test_reordered_landing_header_fails_loudly(spark, tmp_out):
    import pytest
    p = tmp_out + "/dvf"
    df = spark.createDataFrame([ROW], C.RAW_SALES)
    SK.land_csv(df, p, "2024-12-30")
    SK.land_csv(df.select(*reversed(df.columns)), p, "2024-12-31")
    with pytest.raises(Exception):
        R.read_landed_csv(spark, p).collect()
    # Files with differing headers are read by their own header instead.
    u = R.read_whitelisted_csv(spark, [p + "/ingestion_date=2024-12-30", p + "/ingestion_date=2024-12-31"], sep=",")
    assert {r.valeur_fonciere for r in u.collect()} == {"250000"}
