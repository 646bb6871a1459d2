"""Incremental formatting: each landed file is formatted once across runs."""

from pricelens import contracts as C
from pricelens import sinks as SK
from pricelens.streaming.ingest import format_landed_sales

ROW = ("2024-03-15", "250000", "Appartement", "55", "3", "44109", "Nantes", "44")


def test_each_landing_processed_once(spark, tmp_out):
    landed, table, ckpt = tmp_out + "/landed", tmp_out + "/sales", tmp_out + "/ckpt"
    first = spark.createDataFrame([ROW, ROW[:1] + ("",) + ROW[2:]], C.RAW_SALES)
    SK.land_csv(first, landed, "2024-12-30")
    assert format_landed_sales(spark, landed, table, ckpt) == 2
    assert spark.read.parquet(table).count() == 1  # the blank price is rejected
    assert format_landed_sales(spark, landed, table, ckpt) == 0  # nothing new landed
    second = spark.createDataFrame([ROW[:1] + ("300000",) + ROW[2:]], C.RAW_SALES)
    SK.land_csv(second, landed, "2024-12-31")
    assert format_landed_sales(spark, landed, table, ckpt) == 1
    rows = spark.read.parquet(table).collect()
    assert sorted(r.sale_price for r in rows) == [250000.0, 300000.0]
    assert {r.year for r in rows} == {2024}


def test_streamed_segment_state_equals_batch_stats(spark, tmp_out):
    from pyspark.sql import functions as F

    from pricelens.operators import market as MKT
    from pricelens.plans import daily as P
    from pricelens.sources import fixtures as FX
    from pricelens.streaming.ingest import segment_stats_from_state, update_segment_state
    from tests.conftest import SF_SMALL
    landed, state, ckpt = tmp_out + "/landed", tmp_out + "/state", tmp_out + "/ckpt"
    raw = FX.raw_sales(spark, SF_SMALL)
    early = F.coalesce(F.substring("date_mutation", 1, 4) <= "1997", F.lit(False))
    SK.land_csv(raw.filter(early), landed, "2024-12-30")
    update_segment_state(spark, landed, state, ckpt)
    SK.land_csv(raw.filter(~early), landed, "2024-12-31")
    update_segment_state(spark, landed, state, ckpt)
    assert update_segment_state(spark, landed, state, ckpt) == 0  # nothing new
    got = {tuple(r) for r in segment_stats_from_state(spark, state).collect()}
    want = {tuple(r) for r in MKT.segment_stats(P.formatted_sales(spark, SF_SMALL)).collect()}
    assert got == want


def test_every_batch_counts(spark, tmp_out):
    landed, table, ckpt = tmp_out + "/landed", tmp_out + "/sales", tmp_out + "/ckpt"
    rows = spark.createDataFrame([ROW] * 104, C.RAW_SALES).repartition(104)
    SK.land_csv(rows, landed, "2024-12-30")
    files = len(spark.read.format("binaryFile").load(landed).select("path").collect())
    assert format_landed_sales(spark, landed, table, ckpt, max_files_per_trigger=1) == 104
    assert files > 1
