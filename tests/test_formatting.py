"""Sales / rents / rates formatting, from one-row raw tables (the reference's data
quality cases) and the semantic quirks listed in the survey (Q-1 ... Q-14)."""

import datetime

import pytest

from pricelens import contracts as C
from pricelens.operators import formatting as FMT

DEFAULT_SALE = {
    "date_mutation": "2019-07-04", "valeur_fonciere": "181350", "type_local": "APPARTEMENT",
    "surface_reelle_bati": "48", "nombre_pieces_principales": "2", "code_commune": "35238",
    "nom_commune": "Rennes", "code_departement": "35",
}


def sale(spark, **over):
    row = dict(DEFAULT_SALE, **over)
    return spark.createDataFrame([tuple(row.values())], C.RAW_SALES)


def fmt(spark, **over):
    rows = FMT.format_sales(sale(spark, **over)).collect()
    return rows[0] if rows else None


def test_valid_apartment(spark):
    r = fmt(spark)
    assert r.property_type == "Apartment" and r.commune_code == "35238"
    assert r.price_per_m2 == 3778.13  # 3778.125, half up
    assert r.sale_date == datetime.date(2019, 7, 4) and r.year == 2019
    assert r.rooms == 2 and r.rooms_bucket == "2 rooms" and len(r.sale_id) == 64


def test_valid_house_any_case(spark):
    assert fmt(spark, type_local="Maison").property_type == "House"
    assert fmt(spark, type_local="MAISON").property_type == "House"


@pytest.mark.parametrize("over", [
    {"valeur_fonciere": ""}, {"valeur_fonciere": "0"}, {"valeur_fonciere": "abc"},
    {"surface_reelle_bati": "0"}, {"surface_reelle_bati": ""},
    {"type_local": "Dépendance"}, {"type_local": None},
    {"date_mutation": "15/03/2024"}, {"date_mutation": None},
    {"valeur_fonciere": "nan"},
])
def test_rejected(spark, over):
    assert fmt(spark, **over) is None


def test_commune_code_padding(spark):
    assert fmt(spark, code_commune="75056").commune_code == "75056"
    assert fmt(spark, code_commune="1001").commune_code == "01001"


def test_decimal_comma(spark):
    r = fmt(spark, valeur_fonciere="90700,25", surface_reelle_bati="31,5")
    assert r.sale_price == 90700.25 and r.surface_m2 == 31.5


def test_rooms_lenient_int(spark):
    assert fmt(spark, nombre_pieces_principales="4.0").rooms == 4
    r = fmt(spark, nombre_pieces_principales="x")
    assert r.rooms is None and r.rooms_bucket == "unknown"


def test_missing_raw_columns_are_tolerated(spark):
    df = sale(spark).drop("nom_commune", "code_departement")
    r = FMT.format_sales(df).first()
    assert r.commune_name is None and r.department_code is None


def test_sale_id_matches_formula(spark):
    import hashlib
    r = fmt(spark)
    text = "|".join(["2019-07-04", "35238", "181350.0", "48.0"])
    assert r.sale_id == hashlib.sha256(text.encode()).hexdigest()


def test_reject_reasons(spark):
    raw = spark.createDataFrame(
        [tuple(dict(DEFAULT_SALE, **o).values()) for o in
         [{}, {"valeur_fonciere": ""}, {"surface_reelle_bati": "0"}, {"date_mutation": "x"},
          {"type_local": "Local"}]], C.RAW_SALES)
    got = [r.reject_reason for r in FMT.sales_reject_reason(raw).collect()]
    assert got == ["OK", "invalid_price", "invalid_surface", "invalid_date", "not_residential"]


# ── rents ──

def test_rents_decimal_comma_and_aliases(spark):
    raw = spark.createDataFrame([("35238", "Rennes", "14,9", "11.25", "2023")],
                                [" Code_Commune ", "NOM_COMMUNE", "loyer_m2_appartement", "loyer_maison_m2",
                                 "source_year"])
    r = FMT.format_rents(raw).first()
    assert (r.commune_code, r.commune_name, r.rent_m2_apartment, r.rent_m2_house, r.source_year) == \
        ("35238", "Rennes", 14.9, 11.25, 2023)


def test_rents_filters(spark):
    raw = spark.createDataFrame([(None, "15.8", "12.5"), ("1001", None, None), ("1002", None, "9")],
                                "code_commune string, loyer_m2_appartement string, loyer_m2_maison string")
    rows = FMT.format_rents(raw, source_year=2025).collect()
    assert [(r.commune_code, r.rent_m2_house, r.source_year) for r in rows] == [("01002", 9.0, 2025)]


def test_rents_missing_code_column_raises(spark):
    raw = spark.createDataFrame([("15.8",)], ["loyer_m2_appartement"])
    with pytest.raises(ValueError):
        FMT.format_rents(raw)


def test_merge_rents_pads_before_joining(spark):
    apt = spark.createDataFrame([("1001", "15,8", "Ain")], ["INSEE_C", "loypredm2", "LIBGEO"])
    house = spark.createDataFrame([("01001", "12,5"), ("2002", "9")], ["codgeo", "loyerm2"])
    rows = sorted(FMT.merge_rents(apt, house).collect(), key=lambda r: r.code_commune)
    assert [tuple(r) for r in rows] == [("01001", "15,8", "Ain", "12,5"), ("02002", None, None, "9")]


def test_merge_rents_unknown_headers(spark):
    apt = spark.createDataFrame([("1001", "15")], ["zzz", "loypredm2"])
    house = spark.createDataFrame([("1001", "12")], ["codgeo", "loyerm2"])
    with pytest.raises(ValueError):
        FMT.merge_rents(apt, house)


# ── rates ──

def test_rates_parse_and_filter(spark):
    raw = spark.createDataFrame(
        [("2024-11-20", 3.4, "ESTR", "ECB"), ("2024-11-21", None, "ESTR", "ECB"), ("bad", 3.1, "ESTR", "ECB")],
        C.RAW_RATES)
    rows = FMT.format_rates(raw, "2024-12-01").collect()
    assert [(r.rate_date, r.rate_value, r.rate_type, r.ingestion_date) for r in rows] == \
        [(datetime.date(2024, 11, 20), 3.4, "ESTR", datetime.date(2024, 12, 1))]


def test_latest_rate_per_type_is_deterministic(spark):
    raw = spark.createDataFrame(
        [("2024-11-20", 3.4, "A", "s"), ("2024-11-21", 3.5, "A", "s"), ("2024-11-21", 3.3, "A", "s"),
         ("2024-11-19", 1.0, "B", "s")], C.RAW_RATES)
    rows = FMT.latest_rates_per_type(FMT.format_rates(raw, "2024-12-01")).collect()
    got = sorted((r.rate_type, str(r.rate_date), r.rate_value) for r in rows)
    assert got == [("A", "2024-11-21", 3.5), ("B", "2024-11-19", 1.0)]


def test_last_n_rates(spark):
    raw = spark.createDataFrame([(f"2024-11-{d:02d}", float(d), "A", "s") for d in range(1, 21)], C.RAW_RATES)
    rows = FMT.last_n_rates(FMT.format_rates(raw, "2024-12-01"), 5).collect()
    assert sorted(r.rate_value for r in rows) == [16.0, 17.0, 18.0, 19.0, 20.0]


def test_scope_prunes_year_partitions(spark, tmp_out):
    from pyspark.sql import functions as F
    df = FMT.format_sales(spark.createDataFrame(
        [tuple(dict(DEFAULT_SALE, date_mutation=d, code_departement=dep).values())
         for d, dep in [("2022-01-01", "75"), ("2023-01-01", "75"), ("2023-01-01", "44")]], C.RAW_SALES))
    df.write.partitionBy("year").parquet(tmp_out + "/sales")
    scoped = FMT.scope_sales(spark.read.parquet(tmp_out + "/sales"), [2023], ["75"])
    assert scoped.count() == 1
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "year" in plan
    assert FMT.scope_sales(df).count() == 3 and F is not None


def test_rents_alias_does_not_duplicate_an_existing_target(spark):
    raw = spark.createDataFrame([("44109", "X", "15.8", "12.5")],
                                ["commune_code", "code_commune", "loyer_m2_appartement", "loyer_m2_maison"])
    r = FMT.format_rents(raw, source_year=2025).first()
    assert r.commune_code == "44109"
