"""The driver's TPC-H-like tables re-shaped into the domain's raw tables.

The mapping is the one written down in FIXTURES.md §2 (including its deliberately
dirty rows), expressed as DataFrame plans so that every derived table grows with the
input tables. Nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions import exprs as X
from pricelens.session import sf_table

# Fixed values of the mapping (FIXTURES.md §2).
DIRTY_MODULUS = 50
DIRTY_BLANK_PRICE = 0
DIRTY_ZERO_SURFACE = 1
DIRTY_BAD_DATE = 2
BAD_DATE_TEXT = "15/03/2024"
COMMUNE_OFFSET = 1000
RAW_TYPE_BY_FLAG = {"A": "Appartement", "R": "MAISON"}
RAW_TYPE_DEFAULT = "Dépendance"
LISTING_TYPE_BY_FLAG = {"A": "Apartment", "R": "House"}
LISTING_TYPE_DEFAULT = "Office"
RENT_STATUS_APARTMENT = ("F", "P")
RENT_STATUS_HOUSE = ("O",)
RENT_DIVISOR = 10000
RATES_SOURCE = "events"
OPEN_LINE_STATUS = "O"


def _text_decimal(c, scale: int):
    """``cast(cast(c as decimal(12,s)) as string)`` with ``.`` -> ``,``."""
    return F.translate(c.cast(f"decimal(12,{scale})").cast("string"), ".", ",")


def _flag_map(flag, mapping: dict, default: str):
    expr = None
    for k, v in mapping.items():
        expr = F.when(flag == k, v) if expr is None else expr.when(flag == k, v)
    return expr.otherwise(default)


def _commune_text(nationkey):
    return (F.lit(COMMUNE_OFFSET) + nationkey).cast("string")


def _sold_lines(spark: SparkSession, sf_dir: str, columns) -> DataFrame:
    """lineitem joined to its supplier and nation (no hints: AQE sizes the joins)."""
    li = sf_table(spark, sf_dir, "lineitem").select(*columns)
    sup = sf_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation has 25 rows by definition of the schema: a proven bound for broadcast.
    nat = F.broadcast(sf_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    # lineitem joins its supplier first: Spark sizes that join from real statistics
    # (a pre-joined supplier x nation would be estimated as a product and make the
    # planner pick lineitem as the build side).
    return li.join(sup, li.l_suppkey == sup.s_suppkey).join(nat, F.col("s_nationkey") == nat.n_nationkey)


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_sales: eight text columns, one row per line item."""
    df = _sold_lines(spark, sf_dir, ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                                     "l_returnflag", "l_quantity", "l_linenumber"])
    dirty = F.col("l_partkey") % DIRTY_MODULUS
    return df.select(
        F.when(dirty == DIRTY_BAD_DATE, F.lit(BAD_DATE_TEXT))
        .otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("date_mutation"),
        F.when(dirty == DIRTY_BLANK_PRICE, F.lit(""))
        .otherwise(_text_decimal(F.col("l_extendedprice"), 2)).alias("valeur_fonciere"),
        _flag_map(F.col("l_returnflag"), RAW_TYPE_BY_FLAG, RAW_TYPE_DEFAULT).alias("type_local"),
        F.when(dirty == DIRTY_ZERO_SURFACE, F.lit("0"))
        .otherwise(_text_decimal(F.col("l_quantity"), 1)).alias("surface_reelle_bati"),
        F.col("l_linenumber").cast("string").alias("nombre_pieces_principales"),
        _commune_text(F.col("s_nationkey")).alias("code_commune"),
        F.col("n_name").alias("nom_commune"),
        F.col("n_regionkey").cast("string").alias("code_departement"),
    )


def rent_side(spark: SparkSession, sf_dir: str, status: tuple[str, ...], code_header: str,
              rent_header: str, year_header: str = "annee") -> DataFrame:
    """One rent indicator file: mean order total / 10000 per (nation, order year) for
    orders of some statuses, with its own header spelling (so alias resolution has work)."""
    orders = sf_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice",
                                                      "o_orderdate")
    cust = sf_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    df = (orders.filter(F.col("o_orderstatus").isin(*status))
          .join(cust, orders.o_custkey == cust.c_custkey)
          .groupBy(_commune_text(F.col("c_nationkey")).alias(code_header),
                   F.year("o_orderdate").alias(year_header))
          .agg((F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double")
                / F.count(F.lit(1)) / RENT_DIVISOR).alias("_r")))
    return df.select(code_header, year_header,
                     F.translate(F.col("_r").cast("decimal(18,2)").cast("string"), ".", ",")
                     .alias(rent_header))


def rent_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The apartment file and the house file, as landed (differently spelled headers)."""
    apt = rent_side(spark, sf_dir, RENT_STATUS_APARTMENT, " INSEE_C", "loypredm2 ")
    house = rent_side(spark, sf_dir, RENT_STATUS_HOUSE, "CODGEO", "LOYERM2")
    return apt, house


def raw_rents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_rents: the two files merged FULL OUTER on commune and year."""
    from pricelens.operators.formatting import merge_rents
    apt, house = rent_sources(spark, sf_dir)
    return merge_rents(apt, house)


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_rates: date text, value, type and source, plus ``ts`` and ``event_id`` that
    serve as deterministic tie-breaks for the latest-observation windows."""
    ev = sf_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return ev.select(
        F.col("ts").cast("date").cast("string").alias("date"),
        F.col("value").alias("rate_value"),
        F.col("event_type").alias("rate_type"),
        F.lit(RATES_SOURCE).alias("source"),
        F.col("ts"),
        F.col("event_id"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open line items as listings to value (keyed by order, line, part, supplier)."""
    df = _sold_lines(spark, sf_dir, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                     "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"])
    return df.filter(F.col("l_linestatus") == OPEN_LINE_STATUS).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        X.commune_code(_commune_text(F.col("s_nationkey"))).alias("commune_code"),
        _flag_map(F.col("l_returnflag"), LISTING_TYPE_BY_FLAG, LISTING_TYPE_DEFAULT).alias("property_type"),
        X.rooms_bucket(F.col("l_linenumber")).alias("rooms_bucket"),
        F.col("l_quantity").alias("surface_m2"),
        F.col("l_extendedprice").alias("asked_price"),
    )


def raw_rates_detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate observations at full time resolution (for the SDMX round trip): the period
    is the event timestamp as ISO text with microseconds."""
    ev = sf_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return ev.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("period"),
        F.col("value").alias("rate_value"),
        F.col("event_type").alias("rate_type"),
        F.lit(RATES_SOURCE).alias("source"),
        F.col("event_id"),
    )
