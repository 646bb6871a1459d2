"""Segment statistics (approximate and exact), estimates, and valuation of listings,
checked against brute-force Python computations on small fixtures."""

import math
import random

import pytest

from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens.operators import market as MKT
from pricelens.operators import valuation as VAL
from pricelens.plans import daily as P
from tests.conftest import SF_SMALL


def disc(values, q):
    v = sorted(values)
    return v[max(0, math.ceil(q * len(v)) - 1)]


def sales_df(spark, rows):
    return spark.createDataFrame(
        [("id%d" % i, "01001", "N", "1", t, b, p) for i, (t, b, p) in enumerate(rows)],
        "sale_id string, commune_code string, commune_name string, department_code string, "
        "property_type string, rooms_bucket string, price_per_m2 double")


def test_segment_stats_match_percentile_disc_including_a_hot_segment(spark):
    rnd = random.Random(7)
    rows = [("Apartment", "3 rooms", round(rnd.uniform(1000, 9000), 2)) for _ in range(3000)]  # hot
    rows += [("House", "1 room", round(rnd.uniform(1000, 9000), 2)) for _ in range(7)]
    rows += [("House", "2 rooms", 5.0)]
    df = sales_df(spark, rows).repartition(8)
    for exact in (False, True):
        got = {(r.property_type, r.rooms_bucket): r for r in MKT.segment_stats(df, exact=exact).collect()}
        for key in {(t, b) for t, b, _ in rows}:
            vals = [p for t, b, p in rows if (t, b) == key]
            r = got[key]
            assert r.transaction_count == len(vals)
            assert (r.q25_price_m2, r.median_price_m2, r.q75_price_m2) == \
                (disc(vals, .25), disc(vals, .5), disc(vals, .75))
            cents = sum(round(v * 100) for v in vals)
            assert r.avg_price_m2 == ((2 * cents + len(vals)) // (2 * len(vals))) / 100.0


def test_null_names_form_their_own_segment(spark):
    df = spark.createDataFrame([("a", "01001", None, "1", "House", "1 room", 10.0),
                                ("b", "01001", "X", "1", "House", "1 room", 20.0)],
                               "sale_id string, commune_code string, commune_name string, "
                               "department_code string, property_type string, rooms_bucket string, "
                               "price_per_m2 double")
    for exact in (False, True):
        assert MKT.segment_stats(df, exact=exact).count() == 2


def test_attach_rate_empty_rates_gives_null(spark):
    seg = spark.createDataFrame([("01001",)], ["commune_code"])
    rates = spark.createDataFrame([], C.RATES)
    assert MKT.attach_rate(seg, rates).first().latest_rate_value is None


def test_estimates_contract(spark):
    est = P.estimates(spark, SF_SMALL)
    assert C.missing_columns(est, C.ESTIMATES) == []
    assert C.type_mismatches(est, C.ESTIMATES) == []
    assert est.filter(C.confidence_violation()).count() == 0


def _estimates(spark):
    rows = [("01001", "Nantes", "44", "Apartment", "3 rooms", 120, 4300.0, 4310.0, 4000.0, 4700.0,
             16.0, 0.0447, 3.4, 0.69, "HIGH", "2024-12-31"),
            ("01001", "Nantes", "44", "Apartment", "3 rooms", 50, 1.0, 1.0, 1.0, 1.0,
             16.0, 0.0447, 3.4, 0.69, "MEDIUM", "2024-12-30")]
    df = spark.createDataFrame(rows, [f.name for f in C.ESTIMATES.fields if f.name != "computation_date"]
                               + ["d"])
    return df.withColumn("computation_date", F.col("d").cast("date")).drop("d")


def test_value_listings_quote_semantics(spark):
    listings = spark.createDataFrame(
        [(1, "01001", "Apartment", "3 rooms", 55.0, 250000.0),
         (2, "01001", "Apartment", "3 rooms", 55.0, 200000.0),
         (3, "01001", "Apartment", "3 rooms", 55.0, 258501.0),
         (4, "01001", "House", "3 rooms", 55.0, 1.0),
         (5, "01001", "Apartment", "3 rooms", 0.0, 1.0)],
        "id long, commune_code string, property_type string, rooms_bucket string, surface_m2 double, "
        "asked_price double")
    out = {r.id: r for r in VAL.value_listings(listings, _estimates(spark)).collect()}
    assert set(out) == {1, 2, 3, 4}  # surface 0 is rejected (FLT-11)
    assert (out[1].label, out[1].low_fair_price, out[1].high_fair_price, out[1].estimated_fair_price) == \
        ("FAIRLY_PRICED", 220000.0, 258500.0, 236500.0)
    assert out[1].computation_date == "2024-12-31" and out[1].confidence == "HIGH"  # newest run
    assert out[2].label == "UNDERPRICED" and out[3].label == "OVERPRICED"
    assert out[4].status == "NO_REFERENCE" and out[4].label is None
    unmatched = VAL.unmatched_listings(listings, _estimates(spark)).collect()
    assert [r.id for r in unmatched] == [4]
    assert [r.id for r in VAL.invalid_listings(listings).collect()] == [5]


def test_bounds_exact_vs_quote(spark):
    est = _estimates(spark).withColumn("q25_price_m2", F.lit(1000.3))
    listing = spark.createDataFrame([(1, "01001", "Apartment", "3 rooms", 1.0, 1000.1)],
                                    "id long, commune_code string, property_type string, rooms_bucket string, "
                                    "surface_m2 double, asked_price double")
    assert VAL.value_listings(listing, est).first().label == "FAIRLY_PRICED"  # vs 1000 (rounded)
    assert VAL.value_listings(listing, est, bounds="exact").first().label == "UNDERPRICED"


def test_market_profiles_match_brute_force(spark):
    est = P.estimates(spark, SF_SMALL)
    rows = est.collect()
    prof = {r.commune_code: r for r in VAL.market_profiles(est).collect()}
    by_code = {}
    for r in rows:
        by_code.setdefault(r.commune_code, []).append(r)
    assert set(prof) == set(by_code)
    for code, segs in by_code.items():
        p = prof[code]
        assert p.segment_count == len(segs)
        expected = sorted((s.property_type, s.rooms_bucket, s.transaction_count, s.median_price_m2) for s in segs)
        got = [(s.property_type, s.rooms_bucket, s.transaction_count, s.median_price_m2) for s in p.segments]
        assert got == expected
        first = min(segs, key=lambda s: (s.property_type, s.rooms_bucket, s.commune_name or "", s.department_code or ""))
        assert p.commune_name == first.commune_name
    one = VAL.market_profiles(est, commune_code=rows[0].commune_code).collect()
    assert len(one) == 1


def test_communes_sorted_nulls_last(spark):
    est = spark.createDataFrame([("01002", None, "1"), ("01001", "B", "1"), ("01003", "A", "1"),
                                 ("01003", "A", "1")], ["commune_code", "commune_name", "department_code"])
    got = [(r.commune_code, r.commune_name) for r in VAL.list_communes(est).collect()]
    assert got == [("01003", "A"), ("01001", "B"), ("01002", None)]
    assert VAL.commune_count(est).first().commune_count == 3


def test_segment_with_only_null_prices(spark):
    df = spark.createDataFrame([("a", "01001", "N", "1", "House", "1 room", None)],
                               "sale_id string, commune_code string, commune_name string, "
                               "department_code string, property_type string, rooms_bucket string, "
                               "price_per_m2 double")
    for method in ("sketch", "approx", "exact"):
        r = MKT.segment_stats(df, method=method).first()
        assert r.transaction_count == 1 and r.median_price_m2 is None and r.avg_price_m2 is None


def test_value_listings_shuffle_path_matches_broadcast_path(spark):
    from pricelens.sources import fixtures as FX
    est = P.estimates(spark, SF_SMALL)
    lst = FX.listings(spark, SF_SMALL)
    a = VAL.value_listings(lst, est)
    shuffled = VAL.prepared_reference(est, broadcast_max_rows=0)  # above the limit: shuffle join
    hinted = VAL.prepared_reference(est)
    for ref in (shuffled, hinted):
        b = VAL.value_listings(lst, reference=ref)
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
        assert VAL.unmatched_listings(lst, reference=ref).count() == VAL.unmatched_listings(lst, est).count()


def test_exact_method_beyond_sketch_size(spark):
    rnd = random.Random(11)
    rows = [("Apartment", "3 rooms", round(rnd.uniform(1000, 9000), 2)) for _ in range(MKT.SKETCH_K * 2 + 7)]
    df = sales_df(spark, rows).repartition(16)
    vals = [p for _, _, p in rows]
    exact = MKT.segment_stats(df, method="exact").first()
    assert (exact.q25_price_m2, exact.median_price_m2, exact.q75_price_m2) == \
        (disc(vals, .25), disc(vals, .5), disc(vals, .75))
    # The sketch methods are approximate past the sketch size: within a small rank error.
    srt = sorted(vals)
    for method in ("sketch", "approx"):
        r = MKT.segment_stats(df, method=method).first()
        for q, v in ((.25, r.q25_price_m2), (.5, r.median_price_m2), (.75, r.q75_price_m2)):
            rank = sum(1 for x in srt if x <= v) / len(srt)
            assert abs(rank - q) < 0.01


def test_exact_quantiles_of_a_hot_segment_repeat(spark):
    n = 400_000
    hot = spark.range(0, n, 1, 24).selectExpr(
        "cast(id as string) sale_id", "'01001' commune_code", "'N' commune_name", "'1' department_code", "'House' property_type",
        "if(id % 1000 = 0, null, '1 room') rooms_bucket", "cast(pmod(xxhash64(id), 400000) as double) / 100 + 1000 price_per_m2")
    runs = [sorted(map(tuple, MKT.segment_stats(hot).collect()), key=str) for _ in range(3)]
    assert runs[0] == runs[1] == runs[2]
    for rooms, count, median, _, q25, q75 in [r[4:] for r in runs[0]]:
        vals = [r[0] for r in hot.where(F.col("rooms_bucket").eqNullSafe(F.lit(rooms))).select("price_per_m2").collect()]
        assert (count, median, q25, q75) == (len(vals), round(disc(vals, .5), 2), round(disc(vals, .25), 2), round(disc(vals, .75), 2))


def test_histograms_of_odd_prices(spark):
    prices = [0.0, -5.0, -5.5, 0.01, 1e-300, 1e300, float("nan"), 7.0, 7.0, 7.01]
    df = sales_df(spark, [("House", "1 room", p) for p in prices])
    got = MKT.segment_stats(df).first()
    ranked = sorted(prices, key=lambda p: (p != p, p))
    assert got.median_price_m2 == round(ranked[4], 2) and got.q25_price_m2 == ranked[2]
    state = MKT.segment_histogram(df)
    assert MKT.stats_from_histogram(MKT.merge_histograms(state, state)).first().transaction_count == 20


def test_nan_listings_are_invalid(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(1, 1.0, 1.0), (2, nan, 1.0), (3, 1.0, nan), (4, 0.0, 1.0), (5, None, 1.0)], "id long, surface_m2 double, asked_price double")
    assert [r.id for r in VAL.valid_listings(rows).collect()] == [1]
    assert sorted(r.id for r in VAL.invalid_listings(rows).collect()) == [2, 3, 4, 5]


def test_consumers_see_one_run(spark):
    est = _estimates(spark)
    two = est.withColumn("computation_date", F.lit("2023-01-01").cast("date")).unionByName(est)
    assert VAL.market_profiles(two).first().segment_count == VAL.market_profiles(est).first().segment_count
    assert VAL.latest_run(two, "2023-01-01").count() == est.count()


def test_quote_one_listing(spark):
    import pytest
    est = _estimates(spark)
    q = VAL.quote(est, "01001", "Apartment", "3 rooms", 55, 250000)
    assert (q["label"], q["low_fair_price"], q["high_fair_price"], q["estimated_fair_price"]) == \
        ("FAIRLY_PRICED", 220000.0, 258500.0, 236500.0)
    assert q["confidence"] == "HIGH" and q["computation_date"] == "2024-12-31" and q["transaction_count"] == 120
    with pytest.raises(LookupError):
        VAL.quote(est, "99999", "Apartment", "3 rooms", 55, 250000)
    with pytest.raises(ValueError):
        VAL.quote(est, "01001", "Apartment", "3 rooms", 0, 250000)


def test_value_listings_defaults_for_absent_columns(spark):
    est = _estimates(spark).drop("fair_price_confidence", "transaction_count", "estimated_gross_yield",
                                 "latest_rate_value", "computation_date").limit(1)
    listing = spark.createDataFrame([(1, "01001", "Apartment", "3 rooms", 55.0, 250000.0)],
                                    "id long, commune_code string, property_type string, rooms_bucket string, "
                                    "surface_m2 double, asked_price double")
    r = VAL.value_listings(listing, est).first()
    assert (r.confidence, r.transaction_count, r.estimated_gross_yield, r.latest_rate_value,
            r.computation_date, r.status) == ("LOW", 0, None, None, None, "OK")


def test_absurd_price_does_not_fail_the_job(spark):
    df = sales_df(spark, [("House", "1 room", 1e300), ("House", "1 room", 100.0), ("House", "1 room", 300.0)])
    for method in ("sketch", "approx", "exact"):
        r = MKT.segment_stats(df, method=method).first()
        # The mean is that of all prices, also of one too large for the exact decimal.
        assert r.transaction_count == 3 and r.avg_price_m2 == pytest.approx(1e300 / 3) and r.q75_price_m2 == 1e300
    df = sales_df(spark, [("House", "1 room", 1e27), ("House", "1 room", 100.0)])
    for method in ("sketch", "approx", "exact"):
        assert MKT.segment_stats(df, method=method).first().avg_price_m2 == pytest.approx(5e26)


def test_market_profile_json_drops_nulls(spark):
    import json
    est = P.estimates(spark, SF_SMALL)
    prof = VAL.market_profiles(est, as_json=True).collect()
    by_code = {}
    for r in est.collect():
        by_code.setdefault(r.commune_code, []).append(r)
    for p in prof:
        segs = json.loads(p.segments)
        assert len(segs) == p.segment_count == len(by_code[p.commune_code])
        for seg in segs:
            assert None not in seg.values() and seg["computation_date"] == "2024-12-31"
        missing_rent = sum(1 for r in by_code[p.commune_code] if r.rent_m2 is None)
        assert sum(1 for seg in segs if "rent_m2" not in seg) == missing_rent


def test_size_check_counts_while_checkpointing(spark):
    from pricelens.operators import joins as J
    df = spark.range(1234).withColumn("x", F.col("id") * 2)
    m, small = J.size_checked_side(df, 1000)
    assert not small and m.count() == 1234
    assert J.size_checked_side(df, 2000)[1]
