"""Valuation operators: classify whole tables of listings against the estimates.

The reference answers one listing per request; here one plan values any number of
listings. The estimates side is one row per segment: ``prepared_reference`` writes and measures
it once and hints the broadcast only within limits (``operators/joins.py``), and then the
listing side is not shuffled. Beyond the limits, and with ``estimates`` as they come, Spark
chooses: a stored table is broadcast by its file size, else the join is by shuffle on the
three lookup keys, with AQE's skew-join splitting for a hot segment. Listings that are valued
again and again against more segments than can be broadcast are stored by ``bucketed.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens.functions import exprs as X
from pricelens.operators.joins import BROADCAST_MAX_ROWS, size_checked_side

LOOKUP = list(C.LOOKUP_KEYS)
#: Copy number of a hot segment in stored tables (``operators/bucketed.py``).
COPY = "_copy"
STATUS_OK = "OK"
STATUS_NO_REFERENCE = "NO_REFERENCE"
DEFAULT_CONFIDENCE = "LOW"
DEFAULT_COUNT = 0
QUOTE_COLUMNS = [
    "commune_code", "commune_name", "property_type", "rooms_bucket", "surface_m2", "asked_price",
    "estimated_fair_price", "low_fair_price", "high_fair_price", "label", "confidence",
    "transaction_count", "median_price_m2", "estimated_gross_yield", "latest_rate_value",
    "computation_date", "status",
]


def latest_estimates(estimates: DataFrame) -> DataFrame:
    """WIN-3 / TOP-2: newest computation per (commune, type, rooms); ties broken by
    transaction count, then name and department, so the pick is deterministic."""
    order = []
    if "computation_date" in estimates.columns:
        order.append(F.col("computation_date").desc_nulls_last())
    if "transaction_count" in estimates.columns:
        order.append(F.col("transaction_count").desc_nulls_last())
    for c in ("commune_name", "department_code"):
        if c in estimates.columns:
            order.append(F.col(c).asc_nulls_last())
    # Any other columns close the order, so the pick never depends on row arrival.
    ranked = set(LOOKUP) | {"computation_date", "transaction_count", "commune_name", "department_code"}
    order += [F.col(c).asc_nulls_last() for c in estimates.columns if c not in ranked]
    w = Window.partitionBy(*LOOKUP).orderBy(*order)
    return estimates.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_run(estimates: DataFrame, computation_date=None) -> DataFrame:
    """The rows of one run: of ``computation_date``, by default of the newest run stored
    (a scalar subquery). A table without computation dates is one run."""
    if "computation_date" not in estimates.columns:
        return estimates
    if computation_date is not None:
        return estimates.filter(F.col("computation_date") == F.lit(computation_date).cast("date"))
    newest = estimates.agg(F.max("computation_date")).scalar()
    return estimates.filter(F.col("computation_date").eqNullSafe(newest))


def _positive(name: str):
    """Above zero and not NaN, which Spark orders above every number; the first half reaches the scan."""
    return (F.col(name) > 0) & ~F.isnan(name)


def valid_listings(listings: DataFrame) -> DataFrame:
    """FLT-11: surface and asked price strictly positive."""
    return listings.filter(_positive("surface_m2") & _positive("asked_price"))


def invalid_listings(listings: DataFrame) -> DataFrame:
    """FLT-11 rejects (a NULL or NaN surface or price counts as invalid)."""
    ok = _positive("surface_m2") & _positive("asked_price")
    return listings.filter(~F.coalesce(ok, F.lit(False)))


def reference_rows(estimates: DataFrame) -> DataFrame:
    """The newest estimate of each (commune, type, rooms), as the lookup side of a valuation."""
    est = latest_estimates(estimates)
    have = set(est.columns)

    def col_or(name, default, dtype):
        return F.col(name) if name in have else F.lit(default).cast(dtype)

    return est.select(
        *LOOKUP,
        col_or("commune_name", None, "string").alias("_ref_name"),
        F.col("q25_price_m2").alias("_q25"), F.col("q75_price_m2").alias("_q75"),
        F.col("median_price_m2").alias("_median"),
        col_or("fair_price_confidence", DEFAULT_CONFIDENCE, "string").alias("_conf"),
        col_or("transaction_count", DEFAULT_COUNT, "long").alias("_count"),
        col_or("estimated_gross_yield", None, "double").alias("_yield"),
        col_or("latest_rate_value", None, "double").alias("_rate"),
        col_or("computation_date", None, "date").alias("_cdate"),
        F.lit(True).alias("_matched"),
    )


def prepared_reference(estimates: DataFrame, broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The lookup side of a valuation, written once (one job) and broadcast if it is small;
    pass it as ``reference`` to value any number of listing tables."""
    return size_checked_side(reference_rows(estimates), broadcast_max_rows)[0]


def value_listings(listings: DataFrame, estimates: DataFrame | None = None, bounds: str = "quote",
                   reference: DataFrame | None = None) -> DataFrame:
    """JOIN-3 + PRJ-21…23 + FLT-10/11: every valid listing with its fair range, label and
    segment facts; listings without a segment get status NO_REFERENCE and NULL facts.

    ``bounds="quote"`` compares against bounds rounded to whole euros (HALF_EVEN);
    ``bounds="exact"`` compares against the unrounded products.
    """
    extra = [c for c in listings.columns if c not in {"commune_code", "property_type", "rooms_bucket",
                                                      "surface_m2", "asked_price", COPY}]
    ref = reference_rows(estimates) if reference is None else reference
    on = [*LOOKUP, COPY] if COPY in ref.columns else LOOKUP
    j = valid_listings(listings).join(ref, on=on, how="left")
    low_x = X.fair_bound("_q25", "surface_m2", whole_euros=False)
    high_x = X.fair_bound("_q75", "surface_m2", whole_euros=False)
    low = F.bround(low_x, 0)
    high = F.bround(high_x, 0)
    cmp_low, cmp_high = (low, high) if bounds == "quote" else (low_x, high_x)
    matched = F.col("_matched").isNotNull()
    return j.select(
        *extra,
        "commune_code",
        F.col("_ref_name").alias("commune_name"),
        "property_type", "rooms_bucket", "surface_m2", "asked_price",
        F.bround(X.fair_bound("_median", "surface_m2", whole_euros=False), 0).alias("estimated_fair_price"),
        low.alias("low_fair_price"),
        high.alias("high_fair_price"),
        F.when(matched, X.verdict("asked_price", cmp_low, cmp_high)).alias("label"),
        F.col("_conf").alias("confidence"),
        F.col("_count").alias("transaction_count"),
        F.col("_median").alias("median_price_m2"),
        F.col("_yield").alias("estimated_gross_yield"),
        F.col("_rate").alias("latest_rate_value"),
        X.iso_date("_cdate").alias("computation_date"),
        F.when(matched, F.lit(STATUS_OK)).otherwise(F.lit(STATUS_NO_REFERENCE)).alias("status"),
    )


def unmatched_listings(listings: DataFrame, estimates: DataFrame | None = None,
                       reference: DataFrame | None = None) -> DataFrame:
    """JOIN-5: valid listings with no segment (left anti join on the lookup keys)."""
    ref = estimates.select(*LOOKUP).distinct() if reference is None else reference.select(*LOOKUP)
    return valid_listings(listings).join(ref, on=LOOKUP, how="left_anti")


def verdict_summary(valued: DataFrame) -> DataFrame:
    """Listings per status and label."""
    return valued.groupBy("status", "label").agg(F.count(F.lit(1)).alias("n_listings"))


def list_communes(estimates: DataFrame, computation_date=None) -> DataFrame:
    """AGG-6 + SET-3 + TOP-3: distinct (code, name, department) of one run, by name (NULLs last)."""
    return (latest_run(estimates, computation_date).select("commune_code", "commune_name", "department_code").distinct()
            .orderBy(F.asc_nulls_last("commune_name"), F.asc("commune_code"), F.asc_nulls_last("department_code")))


def commune_count(estimates: DataFrame, computation_date=None) -> DataFrame:
    """AGG-7: how many distinct (code, name, department) rows one run has (NULLs included)."""
    return (latest_run(estimates, computation_date).select("commune_code", "commune_name", "department_code").distinct()
            .agg(F.count(F.lit(1)).alias("commune_count")))


PROFILE_FIELDS = [
    "property_type", "rooms_bucket", "commune_name", "department_code", "transaction_count",
    "median_price_m2", "avg_price_m2", "q25_price_m2", "q75_price_m2", "rent_m2",
    "estimated_gross_yield", "latest_rate_value", "market_liquidity_score",
    "fair_price_confidence",
]


def market_profiles(estimates: DataFrame, commune_code=None, as_json: bool = False,
                    computation_date=None) -> DataFrame:
    """AGG-8 + FLT-9: one row per commune with its segment list (sorted), the header
    name/department taken from the first segment in that order. Only one run is listed
    (``latest_run``), in which a commune holds at most a handful of segments (types x room
    buckets), so the collected list is bounded.
    ``commune_code`` (text or a Column, e.g. a scalar subquery) keeps one commune; none
    found gives no row. ``as_json=True`` returns the list as JSON text (NULL fields
    dropped, ISO dates)."""
    df = latest_run(estimates, computation_date)
    df = df if commune_code is None else df.filter(F.col("commune_code") == commune_code)
    fields = [c for c in PROFILE_FIELDS if c in df.columns]
    seg = F.struct(*[F.col(c) for c in fields],
                   *([X.iso_date("computation_date").alias("computation_date")]
                     if "computation_date" in df.columns else []))
    first = F.struct("property_type", "rooms_bucket", "commune_name", "department_code")
    out = df.groupBy("commune_code").agg(
        F.min_by("commune_name", first).alias("commune_name"),
        F.min_by("department_code", first).alias("department_code"),
        F.count(F.lit(1)).alias("segment_count"),
        F.sort_array(F.collect_list(seg)).alias("segments"),
    )
    if as_json:
        # The endpoint's shape: a JSON list of segment objects, NULL fields dropped.
        out = out.withColumn("segments", F.to_json("segments"))
    return out


def quote(estimates: DataFrame, commune_code: str, property_type: str, rooms_bucket: str,
          surface_m2: float, asked_price: float, bounds: str = "quote") -> dict:
    """One listing valued through the same batch plan (the request/response form):
    non-positive surface or price raises ``ValueError``; a listing with no segment
    raises ``LookupError``; otherwise the quote fields come back as a dict. Only the one
    answer row reaches the driver."""
    if not (surface_m2 > 0 and asked_price > 0):
        raise ValueError("surface_m2 and asked_price must be greater than 0")
    spark = estimates.sparkSession
    one = spark.createDataFrame([(commune_code, property_type, rooms_bucket, float(surface_m2), float(asked_price))],
                                C.LISTINGS)
    # One listing: filter the estimates to its segment key instead of broadcasting them.
    ref = estimates.filter((F.col("commune_code") == commune_code) & (F.col("property_type") == property_type)
                           & (F.col("rooms_bucket") == rooms_bucket))
    row = value_listings(one, ref, bounds=bounds).first()
    if row is None or row["status"] != STATUS_OK:
        raise LookupError(f"no market reference for commune={commune_code}, type={property_type}, "
                          f"rooms={rooms_bucket}")
    return {k: row[k] for k in QUOTE_COLUMNS if k != "status"}
