"""Table contracts: one ``StructType`` per table, plus the checks built on them.

DQ-1 (required columns), DQ-2 (confidence domain) and PRJ-15 (select-if-present in
canonical order) live here. The checks are plain aggregates, so they run as one
distributed pass and only a handful of counters reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions.exprs import CONFIDENCE_TIERS

S, D, I, L, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.DateType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw layer: every column is text as landed.
RAW_SALES_COLUMNS = (
    "date_mutation", "valeur_fonciere", "type_local", "surface_reelle_bati",
    "nombre_pieces_principales", "code_commune", "nom_commune", "code_departement",
)
RAW_SALES = _struct(*[(c, S) for c in RAW_SALES_COLUMNS])

RAW_RENTS = _struct(("code_commune", S), ("loyer_m2_appartement", S), ("nom_commune", S),
                    ("loyer_m2_maison", S), ("source_year", S))

RAW_RATES = _struct(("date", S), ("rate_value", D), ("rate_type", S), ("source", S))

# Formatted layer.
SALES = _struct(("sale_id", S), ("sale_date", DT), ("year", I), ("commune_code", S),
                ("commune_name", S), ("department_code", S), ("property_type", S),
                ("surface_m2", D), ("rooms", I), ("rooms_bucket", S), ("sale_price", D),
                ("price_per_m2", D))

RENTS = _struct(("commune_code", S), ("commune_name", S), ("rent_m2_apartment", D),
                ("rent_m2_house", D), ("source_year", I))

RATES = _struct(("rate_date", DT), ("rate_value", D), ("rate_type", S), ("ingestion_date", DT))

SEGMENT_KEYS = ("commune_code", "commune_name", "department_code", "property_type", "rooms_bucket")
LOOKUP_KEYS = ("commune_code", "property_type", "rooms_bucket")

# Usage layer: the 16 estimate columns, in order.
ESTIMATES = _struct(
    ("commune_code", S), ("commune_name", S), ("department_code", S), ("property_type", S),
    ("rooms_bucket", S), ("transaction_count", L), ("median_price_m2", D), ("avg_price_m2", D),
    ("q25_price_m2", D), ("q75_price_m2", D), ("rent_m2", D), ("estimated_gross_yield", D),
    ("latest_rate_value", D), ("market_liquidity_score", D), ("fair_price_confidence", S),
    ("computation_date", DT),
)
ESTIMATE_COLUMNS = tuple(f.name for f in ESTIMATES.fields)

LISTINGS = _struct(("commune_code", S), ("property_type", S), ("rooms_bucket", S),
                   ("surface_m2", D), ("asked_price", D))


def select_present(df: DataFrame, canonical) -> DataFrame:
    """PRJ-15: keep the canonical columns that exist, in canonical order."""
    have = set(df.columns)
    return df.select(*[c for c in canonical if c in have])


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project ``df`` onto ``contract``: missing columns become typed NULLs, present ones
    are cast with ``try_cast`` (malformed -> NULL), extra columns are dropped."""
    have = set(df.columns)
    cols: list[Column] = []
    for f in contract.fields:
        if f.name in have:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def missing_columns(df: DataFrame, contract) -> list[str]:
    """DQ-1: names required by the contract that ``df`` lacks (driver-side, schema only)."""
    names = [f.name for f in contract.fields] if isinstance(contract, T.StructType) else list(contract)
    have = set(df.columns)
    return [c for c in names if c not in have]


def type_mismatches(df: DataFrame, contract: T.StructType) -> list[str]:
    """DQ-1 (types): present columns whose type differs from the contract."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return [f.name for f in contract.fields if f.name in actual and actual[f.name] != f.dataType]


def confidence_violation(c="fair_price_confidence") -> Column:
    """DQ-2 predicate: a confidence outside LOW/MEDIUM/HIGH (NULL counts as a violation)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(~col.isin(*CONFIDENCE_TIERS), F.lit(True))
