"""Market operators: formatted sales/rents/rates -> per-segment estimates.

Segment statistics take one pass over the sales, which leaves a narrow written table: a row per
sale with its segment, price bin and price, no shuffle. Counts per bin come from it by a
map-side aggregate (a segment has some thousand bins at most); they give counts, means and the
bin of each quantile. Only the prices of those bins, at most three a segment, are then looked at
one by one. So a segment holding a third of all sales is never in one task, quantiles are exact
and the same on every run, and counts add up over tables: new sales join stored ones, and
sales that were withdrawn enter with negative counts. The rent and rate sides are aggregates of
bounded size joined by AQE's size-checked broadcast; the latest rate is a scalar subquery, not
a driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens.functions import exprs as X
from pricelens.operators.formatting import latest_rates_per_type
from pricelens.operators.joins import size_checked_side, written

KEYS = list(C.SEGMENT_KEYS)
QUANTILES = (0.25, 0.5, 0.75)
# Cents as an exact decimal: averages are computed on it so the mean does not depend
# on the order in which partial sums are combined. A price too large for it (a
# malformed one) enters the mean as a double.
CENTS = "decimal(28,2)"
# Price bins per factor e of the price: a bin is 3 % wide.
BINS_PER_E = 32
# percentile_approx accuracy: relative rank error 1/accuracy; groups smaller than this
# are answered exactly (an element of the input, like percentile_disc).
APPROX_ACCURACY = 10000
# KLL sketch size: a sketch holds every value until it has seen SKETCH_K of them, so a
# segment of up to SKETCH_K sales gets exact percentile_disc quantiles; beyond that the
# normalised rank error is of order 1e-4, like APPROX_ACCURACY's.
SKETCH_K = 10000
# Salt buckets for the two-level sketch merge: each map task feeds one bucket, so a
# segment that appears in every task reaches any one reducer from at most
# (map tasks / SALT_BUCKETS) tasks, and the final merge sees at most SALT_BUCKETS sketches.
SALT_BUCKETS = 256


def _mean(in_range, beyond, n):
    """Mean of all priced sales, HALF_UP to cents; NULL when there is nothing to average.

    ``in_range``: exact decimal sum; ``beyond``: double sum of the prices too large for it
    (NULL when there are none, and then the division is exact too)."""
    exact = F.round(F.try_divide(in_range, n.cast("decimal(20,0)")), 2).cast("double")
    mixed = F.round((F.coalesce(in_range.cast("double"), F.lit(0.0)) + beyond) / n, 2)
    return F.when(beyond.isNull(), exact).otherwise(F.when(n > 0, mixed))


def _sums(price, weight=None):
    """The two sums that ``_mean`` takes, over rows or over rows with a weight."""
    cents = price.try_cast(CENTS)
    large = F.when(cents.isNull(), price)
    if weight is not None:
        cents, large = cents * weight, large * weight
    return F.sum(cents).cast("decimal(38,2)"), F.sum(large)


def _transaction_count(sales: DataFrame):
    """AGG-2: ``count(sale_id)``. Formatted sales carry a non-nullable sale_id, for
    which Spark counts rows without evaluating the hash (and prunes it)."""
    return F.count("sale_id").alias("transaction_count")


def segment_stats(sales: DataFrame, exact: bool = False, method: str = "exact") -> DataFrame:
    """AGG-1…5: count, median, mean, q25 and q75 of price/m2 per segment (rounded to 2).

    Quantiles are ``percentile_disc`` values (the smallest price whose cumulative share
    reaches q). Methods:

    * ``"exact"`` (default): from counts per price bin, then the prices of the bins that hold
      a quantile; exact and repeatable at any size. Writes the narrow table of prices
      (``segment_histogram``) and starts the jobs that find those bins.
    * ``"sketch"``: mergeable KLL sketches in two levels; exact up to ``SKETCH_K`` sales
      per segment, approximate and not repeatable beyond.
    * ``"approx"``: one ``percentile_approx`` call (the reference's function); the final
      merge of a hot segment takes one buffer per map task in a single reducer.
    """
    if exact or method == "exact":
        return stats_from_histogram(segment_histogram(sales))
    if method == "sketch":
        return stats_from_sketches(segment_sketches(sales))
    q = F.percentile_approx("price_per_m2", list(QUANTILES), APPROX_ACCURACY)
    in_range, beyond = _sums(F.col("price_per_m2"))
    agg = sales.groupBy(*KEYS).agg(
        _transaction_count(sales), q.alias("_q"), in_range.alias("_sum"), beyond.alias("_beyond"),
        F.count("price_per_m2").alias("_n"))
    return agg.select(
        *KEYS, "transaction_count",
        F.round(F.col("_q")[1], 2).alias("median_price_m2"),
        _mean(F.col("_sum"), F.col("_beyond"), F.col("_n")).alias("avg_price_m2"),
        F.round(F.col("_q")[0], 2).alias("q25_price_m2"),
        F.round(F.col("_q")[2], 2).alias("q75_price_m2"),
    )


def segment_counts(sales: DataFrame) -> DataFrame:
    """AGG-1 + AGG-2 alone: sales per segment, one aggregate, for callers that need no prices."""
    return sales.groupBy(*KEYS).agg(_transaction_count(sales))


#: A histogram's columns beside the segment: price bin, price, sale ids and rows counted.
HISTOGRAM = ["_bin", "price_per_m2", "_ids", "_rows"]


def histogram_rows(sales: DataFrame, extra_keys=()) -> DataFrame:
    """One row per sale with its segment, price bin, price and counts (a NULL price is counted
    only). Counts add: rows of several tables may be put together, negative ones taken off."""
    return sales.select(
        *KEYS, *extra_keys, _price_bin(F.col("price_per_m2")).alias("_bin"), "price_per_m2",
        F.when(F.col("sale_id").isNotNull(), 1).otherwise(0).cast("long").alias("_ids"), F.lit(1).cast("long").alias("_rows"))


def segment_histogram(sales: DataFrame, extra_keys=()) -> DataFrame:
    """``histogram_rows`` written once to the shared folder: the only pass over the sales, without
    a shuffle. ``extra_keys`` split it further (e.g. by period) in the same pass."""
    return written(histogram_rows(sales, extra_keys), "segment-prices")


def merge_histograms(*states: DataFrame) -> DataFrame:
    """Several histograms (of disjoint sales) as one; extra key columns are left out."""
    cols = [*KEYS, *HISTOGRAM]
    union = states[0].select(*cols)
    for st in states[1:]:
        union = union.unionByName(st.select(*cols))
    return union


def _price_bin(price):
    """A number that never falls as the price rises; NaN is above everything, NULL below."""
    size = F.floor(F.log(F.abs(price)) * BINS_PER_E) + F.lit(1_000_000)
    return (F.when(F.isnan(price), F.lit(10_000_000)).when(price > 0, size).when(price < 0, -size)
            .when(price == 0, F.lit(0)).otherwise(F.lit(-10_000_000)).cast("long"))


def price_bins(rows: DataFrame) -> DataFrame:
    """Counts and exact sums per (segment, price bin) of histogram rows: a map-side aggregate whose
    result is as long as the number of bins in use."""
    price = F.col("price_per_m2")
    in_range, beyond = _sums(price, F.col("_rows"))
    large = F.when(price.isNotNull() & price.try_cast(CENTS).isNull(), F.col("_rows")).otherwise(0)
    return rows.groupBy(*KEYS, "_bin").agg(
        F.sum("_ids").alias("_ids"), F.sum("_rows").alias("_all"),
        F.sum(F.when(price.isNotNull(), F.col("_rows")).otherwise(0)).alias("_c"),
        in_range.alias("_sum"), beyond.alias("_beyond"), F.sum(large).alias("_large"))


def merge_bins(*tables: DataFrame) -> DataFrame:
    """Bins of several tables added up."""
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    return union.groupBy(*KEYS, "_bin").agg(
        *[F.sum(c).alias(c) for c in ("_ids", "_all", "_c")], F.sum("_sum").cast("decimal(38,2)").alias("_sum"),
        F.sum("_beyond").alias("_beyond"), F.sum("_large").alias("_large"))


def _same_segment(prefix: str):
    """A segment's columns, NULLs included, against the prefixed ones."""
    cond = F.lit(True)
    for k in KEYS:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return cond


def target_bins(bins: DataFrame) -> DataFrame:
    """The bins that hold a target rank, at most three a segment, each with the ranks inside it.
    ``bins`` has one row per (segment, bin)."""
    running = Window.partitionBy(*KEYS).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = bins.select(*KEYS, "_bin", "_c", F.sum("_c").over(running).alias("_cum"),
                      F.sum("_c").over(Window.partitionBy(*KEYS)).alias("_n"))
    rank = lambda q: F.ceil(F.col("_n") * F.lit(q))
    hit = F.filter(F.array(*[F.when((F.col("_cum") >= rank(q)) & (F.col("_cum") - F.col("_c") < rank(q)),
                                    F.struct(F.lit(i).alias("i"), (rank(q) - F.col("_cum") + F.col("_c")).alias("r")))
                             for i, q in enumerate(QUANTILES)]), lambda x: x.isNotNull())
    return cum.select(*[F.col(k).alias(f"_t_{k}") for k in KEYS], F.col("_bin").alias("_t_bin"), hit.alias("_hits")).where(
        F.size("_hits") > 0)


def stats_from_bins(bins: DataFrame, prices) -> DataFrame:
    """AGG-2…5 (same columns as ``segment_stats``) from stored bins, one row per (segment, bin), and
    the rows of a histogram: ``prices``, or a function that gives them for a table of target bins.

    The target bins are written and measured; within the limits of ``operators/joins.py`` they are broadcast,
    so prices outside them never leave the scan."""
    total = bins.groupBy(*KEYS).agg(
        F.sum("_ids").alias("transaction_count"), F.sum("_all").alias("_all"), F.sum("_c").alias("_n"),
        F.sum("_sum").cast("decimal(38,2)").alias("_sum"), F.sum("_beyond").alias("_beyond"),
        F.sum("_large").alias("_large")).where(F.col("_all") > 0)
    total = total.withColumn("_beyond", F.when(F.col("_large") > 0, F.col("_beyond")))
    targets, _ = size_checked_side(target_bins(bins), name="target-bins")
    rows = prices(targets) if callable(prices) else prices
    inside = rows.join(targets, (F.col("_bin") == F.col("_t_bin")) & _same_segment("_t_")).groupBy(
        *KEYS, "_bin", "price_per_m2", "_hits").agg(F.sum("_rows").alias("_rows")).where(F.col("_rows") > 0)
    in_bin = Window.partitionBy(*KEYS, "_bin").orderBy("price_per_m2").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_cum", F.sum("_rows").over(in_bin))
    inside = inside.select(*KEYS, "price_per_m2", F.filter("_hits", lambda h: (
        h["r"] <= F.col("_cum")) & (h["r"] > F.col("_cum") - F.col("_rows"))).alias("_hits"))
    quantile = lambda i: F.max(F.when(F.exists("_hits", lambda h: h["i"] == i), F.round("price_per_m2", 2)))
    found = inside.where(F.size("_hits") > 0).groupBy(*[F.col(k).alias(f"_f_{k}") for k in KEYS]).agg(
        *[quantile(i).alias(f"_q{i}") for i in range(len(QUANTILES))])
    return total.join(found, _same_segment("_f_"), "left").select(
        *KEYS, "transaction_count",
        F.col("_q1").alias("median_price_m2"),
        _mean(F.col("_sum"), F.col("_beyond"), F.col("_n")).alias("avg_price_m2"),
        F.col("_q0").alias("q25_price_m2"),
        F.col("_q2").alias("q75_price_m2"),
    )


def stats_from_histogram(state: DataFrame) -> DataFrame:
    """AGG-2…5 read off a written histogram (same columns as ``segment_stats``): its bins are
    written too, then read twice; the histogram is read for its bins and for the target bins' prices."""
    return stats_from_bins(written(price_bins(state), "segment-bins"), state)


def segment_sketches(sales: DataFrame, extra_keys=(), salt_buckets: int = SALT_BUCKETS,
                     sketch_k: int = SKETCH_K) -> DataFrame:
    """Mergeable per-segment state of a fixed size: a KLL sketch of price/m2, the sale
    count, the cent sums and the priced-sale count. Built in two levels (per segment and map-task
    salt, then per segment), so a hot segment is merged by many reducers first.

    States of disjoint sales merge with ``merge_segment_sketches``: a day's new sales
    can be folded into a stored state without re-reading the history. ``extra_keys``
    split each segment's state further (e.g. by period) in the same single pass;
    ``salt_buckets`` (about the square root of the map-task count is a good size) and
    ``sketch_k`` tune the merge fan-in and the exactness threshold."""
    keys = [*KEYS, *extra_keys]
    salted = sales.withColumn("_salt", F.spark_partition_id() % salt_buckets)
    in_range, beyond = _sums(F.col("price_per_m2"))
    level1 = salted.groupBy(*keys, "_salt").agg(
        F.kll_sketch_agg_double("price_per_m2", sketch_k).alias("_sk"),
        _transaction_count(sales).alias("_cnt"), in_range.alias("_sum"), beyond.alias("_beyond"),
        F.count("price_per_m2").alias("_n"),
    )
    return _merge_level(level1, "_cnt", keys, sketch_k)


def _merge_level(df: DataFrame, count_col: str, keys=None, sketch_k: int = SKETCH_K) -> DataFrame:
    return df.groupBy(*(keys or KEYS)).agg(
        F.kll_merge_agg_double("_sk", sketch_k).alias("_sk"),
        F.sum(count_col).alias("transaction_count"),
        F.sum("_sum").cast("decimal(38,2)").alias("_sum"),
        F.sum("_beyond").alias("_beyond"),
        F.sum("_n").alias("_n"),
    )


def merge_segment_sketches(*states: DataFrame) -> DataFrame:
    """Fold several ``segment_sketches`` states (of disjoint sales) into one; extra key
    columns of the inputs are merged away."""
    cols = [*KEYS, "_sk", "transaction_count", "_sum", "_beyond", "_n"]
    union = states[0].select(*cols)
    for st in states[1:]:
        union = union.unionByName(st.select(*cols))
    return _merge_level(union, "transaction_count")


def stats_from_sketches(state: DataFrame) -> DataFrame:
    """AGG-2…5 read off a merged state (same columns as ``segment_stats``)."""
    def quantile(q):
        return F.when(F.col("_n") > 0, F.round(F.kll_sketch_get_quantile_double("_sk", F.lit(q)), 2))

    return state.select(
        *KEYS, "transaction_count",
        quantile(0.5).alias("median_price_m2"),
        _mean(F.col("_sum"), F.col("_beyond"), F.col("_n")).alias("avg_price_m2"),
        quantile(0.25).alias("q25_price_m2"),
        quantile(0.75).alias("q75_price_m2"),
    )


def latest_rents(rents: DataFrame) -> DataFrame:
    """WIN-2: the newest edition per commune (deterministic tie-break on the values)."""
    w = Window.partitionBy("commune_code").orderBy(
        F.col("source_year").desc_nulls_last(),
        F.col("rent_m2_apartment").desc_nulls_last(), F.col("rent_m2_house").desc_nulls_last())
    return rents.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def attach_rent(segments: DataFrame, rents: DataFrame) -> DataFrame:
    """JOIN-1 + PRJ-16: left join the newest rents on commune_code, pick the rent of the
    segment's property type. Rents are one row per commune, so no segment is duplicated."""
    r = latest_rents(rents).select(
        "commune_code",
        F.col("rent_m2_apartment").alias("_rent_apt"),
        F.col("rent_m2_house").alias("_rent_house"))
    j = segments.join(r, on="commune_code", how="left")
    return (j.withColumn("rent_m2", X.rent_for_type("property_type", "_rent_apt", "_rent_house"))
            .drop("_rent_apt", "_rent_house"))


def latest_rate(rates: DataFrame) -> DataFrame:
    """TOP-1: the newest observation over all rate types, as a one-row aggregate
    (ties on the date go to the greatest rate_type, then value). Empty input gives one
    row of NULLs."""
    top = F.max(F.struct("rate_date", "rate_type", "rate_value")).alias("_t")
    return rates.agg(top).select("_t.rate_date", "_t.rate_value", "_t.rate_type")


def attach_rate(segments: DataFrame, rates: DataFrame) -> DataFrame:
    """JOIN-4 + PRJ-17: the latest rate on every segment, as a scalar subquery (NULL when
    there is no rate). ``rates`` are formatted rates; the latest per type is taken first."""
    newest = latest_rate(latest_rates_per_type(rates)).select("rate_value").scalar()
    return segments.withColumn("latest_rate_value", newest.cast("double"))


def enrich(combined: DataFrame, computation_date) -> DataFrame:
    """PRJ-18…20 + PRJ-13: liquidity, gross yield, confidence and the computation date."""
    return combined.withColumns({
        "market_liquidity_score": X.liquidity_score("transaction_count"),
        "estimated_gross_yield": X.gross_yield("rent_m2", "median_price_m2"),
        "fair_price_confidence": X.confidence("transaction_count"),
        "computation_date": F.lit(computation_date).cast("date"),
    })


def fair_price_estimates(sales: DataFrame, rents: DataFrame, rates: DataFrame,
                         computation_date, exact: bool = False, method: str = "exact") -> DataFrame:
    """The usage table: 16 columns per segment, one lazy lineage (combine + enrich fused)."""
    return estimates_from_segments(segment_stats(sales, exact=exact, method=method), rents, rates,
                                   computation_date)


def estimates_from_segments(segments: DataFrame, rents: DataFrame, rates: DataFrame,
                            computation_date) -> DataFrame:
    """Segment statistics -> the 16-column usage table (rent, rate, enrichment)."""
    seg = attach_rate(attach_rent(segments, rents), rates)
    return C.select_present(enrich(seg, computation_date), C.ESTIMATE_COLUMNS)
