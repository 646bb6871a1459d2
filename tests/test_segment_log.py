"""The stored segment state: deltas, withdrawals, reruns, compaction; bytes in proportion to what is new."""

import os

import pytest
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens import sinks as SK
from pricelens.operators import market as MKT
from pricelens.operators import segment_log as LOG
from pricelens.plans import daily as P
from pricelens.sources import fixtures as FX
from tests.conftest import SF_SMALL

SALES = "commune_code string, commune_name string, department_code string, property_type string, rooms_bucket string, price_per_m2 double, sale_id string"


def sales(spark, prices, commune="01001"):
    return spark.createDataFrame([(commune, None, "1", "House", "2 rooms", p, "id") for p in prices], SALES)


def rows(df, file):
    return MKT.histogram_rows(df).withColumn("_file", F.lit(file).cast("long"))


def files(spark, *signed):
    return spark.createDataFrame(signed, "file long, sign int")


def stats(df):
    return {repr(tuple(r)) for r in df.collect()}  # NaN equals itself here


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_one_large_file_is_withdrawn_by_many_tasks(spark, tmp_out):
    """The price rows of a file that is gone are not dealt out by file, which would put them in one task."""
    root = tmp_out + "/log"
    LOG.append(spark, root, "1", rows(sales(spark, [1.0, 2.0, 2.0]), 1), files(spark, (1, 1)))
    back = LOG.state(spark, root).withdrawn(files(spark, (1, -1)).select("file"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(_file" not in plan
    assert sorted((r.price_per_m2, r._rows) for r in back.collect()) == [(1.0, -1), (2.0, -2)]


def test_withdrawn_files_leave_nothing(spark, tmp_out):
    root = tmp_out + "/log"
    odd = [None, float("nan"), 1e300, -5.0, 0.0, 7.25, 7.25]
    one, two, three = sales(spark, odd + [100.0] * 5), sales(spark, [90.0, 110.0, 7.25]), sales(spark, [50.0, 60.0], "01002")
    LOG.append(spark, root, "1", rows(one, 1).unionByName(rows(three, 3)), files(spark, (1, 1), (3, 1)))
    assert stats(LOG.state(spark, root).stats()) == stats(MKT.segment_stats(one.unionByName(three)))
    gone = files(spark, (1, -1), (3, -1))
    state = LOG.state(spark, root)
    LOG.append(spark, root, "2", state.withdrawn(gone.select("file")).unionByName(rows(two, 2)),
               gone.unionByName(files(spark, (2, 1))))
    want = stats(MKT.segment_stats(two))  # the other segment is gone with its file
    assert stats(LOG.state(spark, root).stats()) == want
    assert {r.file for r in LOG.state(spark, root).files().collect()} == {2}
    assert stats(LOG.state(spark, root, before="2").stats()) == stats(MKT.segment_stats(one.unionByName(three)))
    # Folded, nothing of the withdrawn files is stored any more, and the log goes on from there.
    assert LOG.compact(spark, root) == "2" and LOG.compact(spark, root) is None
    folded = LOG.state(spark, root)
    assert folded.runs == (("base", "2"),) and stats(folded.stats()) == want
    assert {r["_file"] for r in folded.prices().select("_file").distinct().collect()} == {2}
    LOG.append(spark, root, "3", rows(one, 4), files(spark, (4, 1)))
    assert stats(LOG.state(spark, root).stats()) == stats(MKT.segment_stats(one.unionByName(two)))
    # A file in the base is withdrawn like any other.
    LOG.append(spark, root, "4", LOG.state(spark, root).withdrawn(files(spark, (2, 1)).select("file")), files(spark, (2, -1)))
    assert stats(LOG.state(spark, root).stats()) == stats(MKT.segment_stats(one))


def test_runs_are_replaced_and_ordered(spark, tmp_out):
    root = tmp_out + "/log"
    LOG.append(spark, root, "1", rows(sales(spark, [1.0]), 1), files(spark, (1, 1)))
    LOG.append(spark, root, "2", rows(sales(spark, [5.0] * 9), 2), files(spark, (2, 1)))
    LOG.append(spark, root, "2", rows(sales(spark, [3.0]), 2), files(spark, (2, 1)))  # a retry
    assert LOG.state(spark, root).stats().first().transaction_count == 2
    with pytest.raises(ValueError, match="comes before"):
        LOG.append(spark, root, "1", rows(sales(spark, [1.0]), 1), files(spark, (1, 1)))
    with pytest.raises(ValueError, match="name of a run"):
        LOG.append(spark, root, "3/../1", rows(sales(spark, [1.0]), 1), files(spark, (1, 1)))
    # A run whose files were never written doesn't count.
    rows(sales(spark, [1.0]), 9).select("*").write.parquet(f"{root}/prices/kind=delta/run=r3")
    assert LOG.state(spark, root).runs == (("delta", "1"), ("delta", "2"))
    assert LOG.state(spark, tmp_out + "/new").runs == ()


def test_only_folders_with_target_bins_are_opened(spark, tmp_out):
    root = tmp_out + "/log"
    spread = [float(10 ** (i / 20)) for i in range(100)]
    LOG.append(spark, root, "1", rows(sales(spark, spread), 1), files(spark, (1, 1)))
    state = LOG.state(spark, root)
    targets = MKT.target_bins(state.bins())
    opened = {r["f"] for r in state.prices(targets).select(F.input_file_name().alias("f")).collect()}
    every = {r["f"] for r in state.prices().select(F.input_file_name().alias("f")).collect()}
    assert 0 < len(opened) <= 3 < len(every)


def test_a_run_writes_in_proportion_to_new_sales(spark, tmp_out):
    raw, lake = tmp_out + "/raw", tmp_out + "/lake"
    df = FX.raw_sales(spark, SF_SMALL)
    part = F.pmod(F.crc32("valeur_fonciere"), F.lit(20))
    SK.land_csv(df.filter(part > 0), raw + "/dvf", "2024-12-30")
    P.run_daily_incremental(spark, raw, lake, "2024-12-30", "2024-12-30", fallback_rate=3.9)
    SK.land_csv(df.filter(part == 0), raw + "/dvf", "2024-12-31")
    n = P.run_daily_incremental(spark, raw, lake, "2024-12-31", "2024-12-31", fallback_rate=3.9)["state"]
    prices = lake + "/state/segments/prices/kind=delta/run=r"
    assert n == P.formatted_sales(spark, SF_SMALL).count() - spark.read.parquet(prices + "2024-12-30").count() < 400
    assert size(prices + "2024-12-31") < size(prices + "2024-12-30")


def test_landing_a_date_again_equals_the_full_run(spark, tmp_out):
    """Also where the new landing has fewer sales, a folder goes, and the log is folded on the way."""
    raw, lake = tmp_out + "/raw", tmp_out + "/lake"
    df = FX.raw_sales(spark, SF_SMALL).limit(300)
    third = F.pmod(F.crc32("valeur_fonciere"), F.lit(3))
    run = lambda day: P.run_daily_incremental(spark, raw, lake, day, day, fallback_rate=3.9, compact_after=2)
    SK.land_csv(FX.raw_rents(spark, SF_SMALL), raw + "/rents", "2024-12-27", sep=";")
    SK.land_csv(df, raw + "/dvf", "2024-12-27")
    run("2024-12-27")
    SK.land_csv(df.filter(third == 1), raw + "/dvf", "2024-12-28")
    run("2024-12-28")
    SK.land_csv(df.filter(third == 0), raw + "/dvf", "2024-12-27")
    run("2024-12-29")
    run("2024-12-30")  # nothing new
    P.run_daily(spark, raw, tmp_out + "/full", "2024-12-30", "2024-12-30", fallback_rate=3.9)
    read = lambda root: {tuple(r) for r in spark.read.parquet(root + "/usage/fair_price_estimates").filter(
        "computation_date = '2024-12-30'").select(*C.ESTIMATE_COLUMNS).collect()}
    assert read(lake) == read(tmp_out + "/full") and len(read(lake)) > 50
    assert any(k == "base" for k, _ in LOG.runs(spark, lake + "/state/segments"))
    with pytest.raises(ValueError, match="comes before"):
        run("2024-12-28")
