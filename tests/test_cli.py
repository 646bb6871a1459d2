"""The command-line jobs, run in-process on the test session."""

import json

from pricelens import cli
from pricelens import contracts as C
from pricelens import sinks as SK
from pricelens.sources import fixtures as FX
from tests.conftest import SF_SMALL


def test_daily_then_value_communes_profiles_export(spark, tmp_out):
    raw = tmp_out + "/raw"
    SK.land_csv(FX.raw_sales(spark, SF_SMALL), raw + "/dvf", "2024-12-31")
    SK.land_csv(FX.raw_rents(spark, SF_SMALL), raw + "/rents", "2024-12-31", sep=";")
    SK.land_json(FX.raw_rates(spark, SF_SMALL).select(*C.RAW_RATES.fieldNames()), raw + "/rates", "2024-12-31")
    res = cli.main(["daily", "--raw-root", raw, "--lake-root", tmp_out + "/lake", "--date", "2024-12-31"],
                   spark=spark)
    assert res["segments"] == 100
    est = tmp_out + "/lake/usage/fair_price_estimates"
    listings = tmp_out + "/listings.csv"
    FX.listings(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(listings)
    n_listings = spark.read.option("header", True).csv(listings).count()
    res = cli.main(["value", "--estimates", est, "--listings", listings, "--out", tmp_out + "/v"], spark=spark)
    assert res["listings"] == n_listings
    n_communes = spark.read.parquet(est).select("commune_code", "commune_name", "department_code").distinct().count()
    assert cli.main(["communes", "--estimates", est, "--out", tmp_out + "/c"], spark=spark)["communes"] == n_communes
    assert cli.main(["profiles", "--estimates", est, "--out", tmp_out + "/p", "--commune", "01003"],
                    spark=spark)["communes"] == 1
    assert cli.main(["export", "--estimates", est, "--out", tmp_out + "/e"], spark=spark)["documents"] == 100
    res = cli.main(["daily-incremental", "--raw-root", raw, "--lake-root", tmp_out + "/lake2",
                    "--date", "2024-12-31"], spark=spark)
    assert res["estimates"] == 100


def test_value_parquet_listings_exact_bounds(spark, tmp_out):
    from pricelens.plans import daily as P
    est = tmp_out + "/est"
    SK.write_parquet(P.estimates(spark, SF_SMALL), est, partition_by=["computation_date"])
    listings = tmp_out + "/listings"
    FX.listings(spark, SF_SMALL).write.parquet(listings)
    res = cli.main(["value", "--estimates", est, "--listings", listings, "--out", tmp_out + "/v",
                    "--bounds", "exact"], spark=spark)
    out = spark.read.parquet(tmp_out + "/v")
    assert res["listings"] == out.count() == spark.read.parquet(listings).count()
    assert {r.status for r in out.select("status").distinct().collect()} == {"OK", "NO_REFERENCE"}


def test_land_published_files(spark, tmp_out):
    published, raw = tmp_out + "/published", tmp_out + "/raw"
    FX.raw_sales(spark, SF_SMALL).write.option("header", True).option("sep", "|").csv(published + "/sales")
    apartments, houses = FX.rent_sources(spark, SF_SMALL)
    apartments.write.option("header", True).option("sep", ";").csv(published + "/apartments")
    houses.write.option("header", True).option("sep", ",").option("quoteAll", True).csv(published + "/houses")
    for name, doc in (("full", {"data": {
            "dataSets": [{"series": {"0": {"observations": {"0": [3.4], "1": [3.2], "7": [9.9], "2": [None]}}}}],
            "structure": {"dimensions": {"observation": [{"id": "TIME_PERIOD", "values": [
                {"id": "2024-11-20"}, {"id": "2024-11-21"}, {"id": "2024-11-22"}]}]}}}}), ("none", {})):
        spark.createDataFrame([(json.dumps(doc, indent=2),)], "value string").coalesce(1).write.text(f"{published}/{name}")
    got = cli.main(["land", "--raw-root", raw, "--date", "2024-12-31", "--sales", published + "/sales", published + "/no-such",
                    "--apartment-rents", published + "/apartments", "--house-rents", published + "/houses",
                    "--rates", published + "/full"], spark=spark)
    assert got == {"sales": FX.raw_sales(spark, SF_SMALL).count(), "sales_files_skipped": 1,
                   "rents": FX.raw_rents(spark, SF_SMALL).count(), "rates": 2}
    res = cli.main(["daily", "--raw-root", raw, "--lake-root", tmp_out + "/lake", "--date", "2024-12-31"], spark=spark)
    assert res["segments"] == 100 and res["formatted_rates"] == 1
    assert cli.main(["land", "--raw-root", tmp_out + "/raw2", "--date", "2024-12-31", "--rates", published + "/none"],
                    spark=spark) == {"rates": 1}  # the fallback row
