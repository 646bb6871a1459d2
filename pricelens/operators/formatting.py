"""Formatting operators: raw text tables -> typed, filtered tables.

All narrow (map-side) transformations except the two rent files' FULL OUTER merge, the
latest-per-type / last-n windows on rates (partial top-k before their shuffle) and the
opt-in de-duplication of replayed landings (map-side pre-aggregated).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens.functions import exprs as X
from pricelens.sources import readers as R

# Raw sales column -> working name (renamed only if present).
SALES_RENAMES = {
    "date_mutation": "sale_date_raw",
    "valeur_fonciere": "sale_price_raw",
    "type_local": "property_type_raw",
    "surface_reelle_bati": "surface_m2_raw",
    "nombre_pieces_principales": "rooms_raw",
    "code_commune": "commune_code",
    "nom_commune": "commune_name",
    "code_departement": "department_code",
}
REJECT_OK = "OK"
REJECT_PRICE = "invalid_price"
REJECT_SURFACE = "invalid_surface"
REJECT_DATE = "invalid_date"
REJECT_TYPE = "not_residential"
REJECT_REASONS = (REJECT_PRICE, REJECT_SURFACE, REJECT_DATE, REJECT_TYPE)


def _typed_sales(raw: DataFrame, keep=()) -> DataFrame:
    """PRJ-1 ... PRJ-6: rename what is present, then parse every field leniently. ``keep``: columns
    carried along as they are."""
    df = raw.withColumnsRenamed({k: v for k, v in SALES_RENAMES.items() if k in raw.columns})
    for needed in SALES_RENAMES.values():
        if needed not in df.columns:
            df = df.withColumn(needed, F.lit(None).cast("string"))
    return df.select(
        X.strict_date("sale_date_raw").alias("sale_date"),
        X.decimal_comma_double("sale_price_raw").alias("sale_price"),
        X.decimal_comma_double("surface_m2_raw").alias("surface_m2"),
        X.lenient_int("rooms_raw").alias("rooms"),
        X.commune_code("commune_code").alias("commune_code"),
        F.col("commune_name").cast("string").alias("commune_name"),
        F.col("department_code").cast("string").alias("department_code"),
        F.col("property_type_raw"),
        *keep,
    )


def parse_sales(raw: DataFrame) -> DataFrame:
    """Typed sales before any row is rejected (the ``sales_parse`` view)."""
    return _typed_sales(raw)


def format_sales(raw: DataFrame, dedup: bool = False, keep=()) -> DataFrame:
    """Raw sales -> the 12-column formatted sales (PRJ-1…12, FLT-1…4), with the ``keep`` columns
    of the raw rows at the end.

    Reading every ingestion date counts a sale once per landing that holds it (the
    reference's behaviour, kept by default). ``dedup=True`` drops identical formatted
    rows, i.e. replayed landings; it does not merge on ``sale_id`` alone, because the
    id formula leaves out type and rooms and distinct sales can share it. The drop is a
    hash aggregate with a map-side pre-aggregation, so a heavily replayed row is reduced
    in every task before the shuffle; it is over the parsed columns, of which the others (the id
    among them) are then made once per distinct sale."""
    df = _typed_sales(raw, keep).filter(
        X.is_positive("sale_price") & X.is_positive("surface_m2")
        & F.col("sale_date").isNotNull() & X.is_residential("property_type_raw"))
    if dedup:  # a type's spellings are one type
        df = df.withColumn("property_type_raw", F.lower("property_type_raw")).dropDuplicates()
    return _formatted(df, keep)


def format_sales_counted(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """``format_sales`` with the count of raw rows and of each reject reason (``rows``, ``OK`` and the
    reasons), observed in the same pass when the result is written."""
    obs = Observation("raw_sales")
    reason = F.col("reject_reason")
    typed = sales_reject_reason(raw).observe(obs, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(reason == r).alias(r) for r in (REJECT_OK, *REJECT_REASONS)])
    return _formatted(typed.filter(reason == REJECT_OK)), obs


def _formatted(df: DataFrame, keep=()) -> DataFrame:
    """The 12 columns of typed sales that passed every rule."""
    return df.select(
        X.sale_id("sale_date", "commune_code", "sale_price", "surface_m2").alias("sale_id"),
        "sale_date",
        F.year("sale_date").alias("year"),
        "commune_code", "commune_name", "department_code",
        X.property_type("property_type_raw").alias("property_type"),
        "surface_m2", "rooms",
        X.rooms_bucket("rooms").alias("rooms_bucket"),
        "sale_price",
        X.price_per_m2("sale_price", "surface_m2").alias("price_per_m2"),
        *keep,
    )


def scope_sales(sales: DataFrame, years=None, departments=None) -> DataFrame:
    """FLT-13: keep the configured sale years and departments. On a formatted table
    written by ``year`` the year predicate prunes partitions at the scan."""
    cond = F.lit(True)
    if years is not None:
        cond = cond & F.col("year").isin(list(years))
    if departments is not None:
        cond = cond & F.col("department_code").isin([str(d) for d in departments])
    return sales.filter(cond)


def sales_reject_reason(raw: DataFrame) -> DataFrame:
    """DQ-3: each raw row with the first rule it fails (or OK), in filter order."""
    df = _typed_sales(raw)
    reason = (F.when(~F.coalesce(X.is_positive("sale_price"), F.lit(False)), REJECT_PRICE)
              .when(~F.coalesce(X.is_positive("surface_m2"), F.lit(False)), REJECT_SURFACE)
              .when(F.col("sale_date").isNull(), REJECT_DATE)
              .when(~F.coalesce(X.is_residential("property_type_raw"), F.lit(False)), REJECT_TYPE)
              .otherwise(REJECT_OK))
    return df.withColumn("reject_reason", reason)


def merge_rents(apartment: DataFrame, house: DataFrame) -> DataFrame:
    """JOIN-2 + SRC-7 + SRC-8: the apartment and house files -> one raw rent table.

    Headers are normalised and resolved by alias; codes are padded on both sides
    *before* the FULL OUTER equi-join (so ``1001`` meets ``01001``); when both files
    carry an edition year the join is on (code, year).
    """
    a = R.normalize_headers(apartment)
    h = R.normalize_headers(house)
    a_code, a_rent = R.find_column(a, R.RENT_FILE_CODE_ALIASES), R.find_column(a, R.RENT_FILE_VALUE_ALIASES)
    h_code, h_rent = R.find_column(h, R.RENT_FILE_CODE_ALIASES), R.find_column(h, R.RENT_FILE_VALUE_ALIASES)
    if not a_code or not a_rent:
        raise ValueError(f"apartment file: no commune code or rent column; columns: {a.columns}")
    if not h_code or not h_rent:
        raise ValueError(f"house file: no commune code or rent column; columns: {h.columns}")
    a_name = R.find_column(a, R.RENT_FILE_NAME_ALIASES)
    a_year, h_year = R.find_column(a, R.RENT_FILE_YEAR_ALIASES), R.find_column(h, R.RENT_FILE_YEAR_ALIASES)
    by_year = a_year is not None and h_year is not None

    def side(df, code, rent, rent_name, name=None, year=None):
        cols = [X.commune_code(code).alias("code_commune"),
                F.col(rent).cast("string").alias(rent_name)]
        if name:
            cols.append(F.col(name).cast("string").alias("nom_commune"))
        if year:
            cols.append(F.col(year).try_cast("int").alias("source_year"))
        return df.select(*cols)

    left = side(a, a_code, a_rent, "loyer_m2_appartement", a_name, a_year if by_year else None)
    right = side(h, h_code, h_rent, "loyer_m2_maison", None, h_year if by_year else None)
    keys = ["code_commune", "source_year"] if by_year else ["code_commune"]
    merged = left.join(right, on=keys, how="full_outer")
    order = ["code_commune", "loyer_m2_appartement", "nom_commune", "loyer_m2_maison", "source_year"]
    return merged.select(*[c for c in order if c in merged.columns])


def format_rents(raw: DataFrame, source_year: int | None = None) -> DataFrame:
    """Raw rents -> formatted rents (SRC-7, SRC-8, PRJ-3, PRJ-5, PRJ-13, FLT-5, FLT-6).

    ``source_year`` stamps a constant edition year; when it is None the file's own
    ``source_year`` column is kept (several editions can then coexist).
    """
    df = R.resolve_aliases(R.normalize_headers(raw), R.RENT_ALIASES,
                           required=("commune_code",))
    for c in ("rent_m2_apartment", "rent_m2_house"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    year = (F.lit(source_year).cast("int") if source_year is not None
            else (F.col("source_year").try_cast("int") if "source_year" in df.columns
                  else F.lit(None).cast("int")))
    df = df.withColumns({
        "commune_code": X.commune_code("commune_code"),
        "rent_m2_apartment": X.decimal_comma_double("rent_m2_apartment"),
        "rent_m2_house": X.decimal_comma_double("rent_m2_house"),
        "source_year": year,
    })
    df = df.filter(F.col("commune_code").isNotNull()
                   & (F.col("rent_m2_apartment").isNotNull() | F.col("rent_m2_house").isNotNull()))
    return C.select_present(df, ["commune_code", "commune_name", "rent_m2_apartment",
                                 "rent_m2_house", "source_year"])


def format_rates(raw: DataFrame, ingestion_date) -> DataFrame:
    """Raw rates -> typed rates (PRJ-2, PRJ-13, PRJ-14, FLT-7), all observations.

    Extra columns of the raw table (tie-break keys such as ``ts``/``event_id``) are kept
    after the four contract columns so the window operators can use them."""
    # The raw folder's own ``ingestion_date`` is replaced by the run's date.
    extra = [c for c in raw.columns
             if c not in ("date", "rate_value", "rate_type", "source", "ingestion_date")]
    df = raw.select(
        X.strict_date("date").alias("rate_date"),
        F.col("rate_value").try_cast("double").alias("rate_value"),
        F.col("rate_type"),
        F.lit(ingestion_date).cast("date").alias("ingestion_date"),
        *extra,
    )
    return df.filter(F.col("rate_date").isNotNull() & F.col("rate_value").isNotNull())


def _rate_order(df: DataFrame):
    """Newest first, then any tie-break columns present, then the value itself."""
    order = [F.col("rate_date").desc()]
    for c in ("ts", "event_id"):
        if c in df.columns:
            order.append(F.col(c).desc())
    order.append(F.col("rate_value").desc())
    return order


def latest_rates_per_type(rates: DataFrame) -> DataFrame:
    """WIN-1: the newest observation per rate type (row_number = 1, deterministic)."""
    w = Window.partitionBy("rate_type").orderBy(*_rate_order(rates))
    return (rates.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select("rate_date", "rate_value", "rate_type", "ingestion_date"))


def last_n_rates(rates: DataFrame, n: int = 30) -> DataFrame:
    """TOP-4: the last ``n`` observations per rate type (a per-key top-k)."""
    w = Window.partitionBy("rate_type").orderBy(*_rate_order(rates))
    return (rates.withColumn("obs_rank", F.row_number().over(w)).filter(F.col("obs_rank") <= n)
            .select("rate_date", "rate_value", "rate_type", "ingestion_date", "obs_rank"))
