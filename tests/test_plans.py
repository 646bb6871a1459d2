"""Plan-shape regression tests: the properties the scale design relies on."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def final_plan(df) -> str:
    """The final adaptive plan, formatted (operator tree and per-node details)."""
    import contextlib
    import io
    df.collect()  # run this DataFrame's own plan so the adaptive plan is final
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_listing_side_is_never_shuffled(spark, q):
    from pricelens.operators import valuation as VAL
    from pricelens.plans import daily as P
    from pricelens.sources import fixtures as FX
    reference = VAL.prepared_reference(P.estimates(spark, SF_SMALL))
    plan = final_plan(VAL.value_listings(FX.listings(spark, SF_SMALL), reference=reference))
    tree = plan.split("+- == Initial Plan ==")[0]
    assert "Exchange" not in tree.replace("BroadcastExchange", "")
    assert "BroadcastHashJoin" in tree
    assert "EqualTo(l_linestatus,O)" in plan and "GreaterThan(l_quantity,0.0)" in plan


@pytest.mark.parametrize("name", ["listing_verdicts", "listing_ranges", "listing_unmatched", "verdict_summary"])
def test_registered_valuations_join_by_broadcast(spark, q, name):
    tree = final_plan(q[name](spark, SF_SMALL)).split("+- == Initial Plan ==")[0]
    assert "SortMergeJoin" not in tree and "ShuffledHashJoin" not in tree
    # Only the summary's own aggregate shuffles.
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == (name == "verdict_summary")


def test_stored_valuations_exchange_nothing(spark):
    """Both sides beyond the broadcast limit: no exchange at all, and no bucket holds the hot third of the listings."""
    from pyspark.sql import functions as F
    from pricelens.operators import bucketed as BK
    from pricelens.plans import queries as Q
    listings, reference = Q.stored_listings(spark, SF_SMALL, hot_rows=100)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("-1", limit):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            for bounds in ("quote", "exact"):
                tree = final_plan(BK.value_stored(listings, reference, bounds)).split("+- == Initial Plan ==")[0]
                assert "SortMergeJoin" in tree and "Exchange" not in tree
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    n = listings.count()
    hot = (F.col("commune_code") == "01005") & (F.col("property_type") == "House") & (F.col("rooms_bucket") == "5+ rooms")
    assert listings.filter(hot).count() > n / 4
    per_file = listings.groupBy(F.input_file_name()).count().toPandas()["count"]
    assert per_file.max() < n / 4
    copies = {r["_copy"]: r["n"] for r in listings.filter(hot).groupBy("_copy").agg(F.count("*").alias("n")).collect()}
    assert len(copies) > 3 and max(copies.values()) <= 2 * 100
    assert listings.filter("property_type is null").select("_copy").distinct().count() > 1


def test_stored_tables_of_no_rows_and_equal_rows(spark, tmp_out):
    from pricelens.operators import bucketed as BK
    from pricelens.operators import valuation as VAL
    from pricelens.plans import daily as P
    est = P.estimates(spark, SF_SMALL)
    kind = "commune_code string, property_type string, rooms_bucket string, surface_m2 double, asked_price double, note string"
    top = est.orderBy(*VAL.LOOKUP).first()
    row = (top.commune_code, top.property_type, top.rooms_bucket, 50.0, 100_000.0, "same")
    for name, rows in (("none", []), ("same", [row] * 50 + [(None, "House", "2 rooms", 50.0, 1.0, "nowhere")] * 20)):
        plain = spark.createDataFrame(rows, kind)
        stored = BK.store_listings(plain, f"test_{name}", f"{tmp_out}/{name}", 4, hot_rows=10)
        ref = BK.store_reference(est, f"test_{name}_ref", f"{tmp_out}/{name}-ref", f"{tmp_out}/{name}", 4)
        got, want = BK.value_stored(stored, ref), VAL.value_listings(plain, est)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert stored.select("_copy").distinct().count() == (5 if rows else 0)


def _scans_of(monkeypatch, table, build):
    """How many scans of ``table`` a query has in all plans that it runs: those that are written on the way, and its own."""
    from pricelens import sinks as SK
    from pricelens.operators import joins as J
    plans, original = [], J.written

    def recorded(df, name):
        plans.append(df)
        return original(df, name)

    from pricelens.operators import market as MKT
    monkeypatch.setattr(J, "written", recorded)
    monkeypatch.setattr(MKT, "written", recorded)
    plans.append(build())
    return sum(f"/{table}.parquet" in root for df in plans for root in SK.input_roots(df))


@pytest.mark.parametrize("name", ["segment_stats", "segment_stats_hot", "fair_price_estimates", "estimates_latest"])
def test_sales_are_scanned_once(spark, q, monkeypatch, name):
    assert _scans_of(monkeypatch, "lineitem", lambda: q[name](spark, SF_SMALL)) == 1


def test_counts_alone_search_no_quantiles(spark, q):
    tree = final_plan(q["segment_confidence"](spark, SF_SMALL)).split("+- == Initial Plan ==")[0]
    assert "Window" not in tree and tree.count("Scan parquet") == 3
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == 1


def test_sketches_merge_in_two_levels(spark, q):
    df = q["segment_stats_sketch"](spark, SF_SMALL)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in logical and "kll_merge_agg_double" in logical
    assert "spark_partition_id" in logical.lower()
    tree = final_plan(df).split("+- == Initial Plan ==")[0]
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == 2


def test_top1_windows_limit_before_the_shuffle(spark, q):
    plan = final_plan(q["rates_latest_per_type"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_formatting_is_one_pipelined_stage(spark, q):
    tree = final_plan(q["sales_formatted"](spark, SF_SMALL)).split("+- == Initial Plan ==")[0]
    assert "Exchange" not in tree.replace("BroadcastExchange", "") and "SortMergeJoin" not in tree


def test_latest_rate_is_a_subquery_not_a_join(spark, q):
    plan = final_plan(q["segment_rate"](spark, SF_SMALL))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark, q):
    plan = final_plan(q["rates_last_n"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan
