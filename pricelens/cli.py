"""Command line: the jobs a user runs, each one Spark application.

    python -m pricelens land     --raw-root R --date 2024-12-31 [--sales F ...]
                                 [--apartment-rents F --house-rents F] [--rates F ...]
    python -m pricelens daily    --raw-root R --lake-root L --date 2024-12-31
    python -m pricelens daily-incremental --raw-root R --lake-root L --date 2024-12-31
    python -m pricelens value    --estimates E --listings X --out O [--bounds exact]
    python -m pricelens communes --estimates E --out O
    python -m pricelens profiles --estimates E --out O [--commune 44109]
    python -m pricelens export   --estimates E --out O [--index NAME] [--date D]
                                 [--requests [--previous LAST_EXPORT]]

The session comes from ``SparkSession.builder.getOrCreate()`` (the cluster supplies the
master and the shared checkpoint folder); ``--cluster-conf`` applies the scale settings
of ``pricelens.session.CLUSTER_CONF``. Outputs are Parquet (JSON lines for ``export``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from pricelens import sinks as SK
from pricelens.operators import export as EX
from pricelens.operators import valuation as VAL
from pricelens.plans import daily as D
from pricelens.plans import landing as L
from pricelens.session import apply_conf
from pricelens.sources import readers as R


def _read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, or header CSV when the path ends in ``.csv``; numeric listing fields
    are cast from text."""
    if path.endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
        casts = {c: df[c].try_cast("double") for c in ("surface_m2", "asked_price") if c in df.columns}
        return df.withColumns(casts) if casts else df
    return spark.read.parquet(path)


def main(argv=None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="pricelens")
    ap.add_argument("--cluster-conf", action="store_true", help="apply CLUSTER_CONF to the session")
    sub = ap.add_subparsers(dest="cmd", required=True)

    la = sub.add_parser("land", help="published files -> raw landing folders")
    la.add_argument("--raw-root", required=True)
    la.add_argument("--date", required=True, help="ingestion date, yyyy-MM-dd")
    la.add_argument("--sales", nargs="*", help="department files or folders (pipe-delimited)")
    la.add_argument("--apartment-rents")
    la.add_argument("--house-rents")
    la.add_argument("--rates", nargs="*", help="SDMX-JSON responses")
    la.add_argument("--rate-type", default=R.FALLBACK_RATE_TYPE)
    la.add_argument("--fallback-rate", type=float, default=R.FALLBACK_RATE)

    inc = sub.add_parser("daily-incremental", help="landings since the last state only, merged into stored segment state")
    inc.add_argument("--raw-root", required=True)
    inc.add_argument("--lake-root", required=True)
    inc.add_argument("--date", required=True, help="computation and ingestion date, yyyy-MM-dd")
    inc.add_argument("--rent-source-year", type=int)
    inc.add_argument("--rates-json-array", action=argparse.BooleanOptionalAction,
                     help="rate files are JSON arrays (default: told file by file)")
    inc.add_argument("--fallback-rate", type=float, help="rate used when no rate file was landed")

    d = sub.add_parser("daily", help="landed files -> formatted layer -> usage table")
    d.add_argument("--raw-root", required=True)
    d.add_argument("--lake-root", required=True)
    d.add_argument("--date", required=True, help="computation and ingestion date, yyyy-MM-dd")
    d.add_argument("--snapshot", choices=["all", "latest"], default="all")
    d.add_argument("--rent-source-year", type=int)
    d.add_argument("--years", type=int, nargs="*")
    d.add_argument("--departments", nargs="*")
    d.add_argument("--rates-json-array", action=argparse.BooleanOptionalAction,
                   help="rate files are JSON arrays (default: told file by file)")
    d.add_argument("--fallback-rate", type=float, help="rate used when no rate file was landed")

    v = sub.add_parser("value", help="classify a table of listings")
    v.add_argument("--estimates", required=True)
    v.add_argument("--listings", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--bounds", choices=["quote", "exact"], default="quote")

    for name, help_ in (("communes", "distinct communes"), ("profiles", "segments per commune"),
                        ("export", "one JSON document per estimate")):
        p = sub.add_parser(name, help=help_)
        p.add_argument("--estimates", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--date", help="computation date of the run to show (default: the newest)")
        if name == "profiles":
            p.add_argument("--commune")
        if name == "export":
            p.add_argument("--index", default=SK.DEFAULT_INDEX)
            p.add_argument("--requests", action="store_true", help="bulk requests bounded in bytes, a file each")
            p.add_argument("--previous", help="with --requests: the folder of the last such export; only changes go out")

    args = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"pricelens-{args.cmd}").getOrCreate()
    if args.cluster_conf:
        apply_conf(spark)

    if args.cmd == "land":
        if bool(args.apartment_rents) != bool(args.house_rents):
            ap.error("--apartment-rents and --house-rents go together")
        result = {}
        if args.sales:
            skipped: list[str] = []
            result["sales"] = L.land_sales(spark, args.sales, args.raw_root, args.date, skipped=skipped)
            result["sales_files_skipped"] = len(skipped)
        if args.apartment_rents:
            result["rents"] = L.land_rents(spark, args.apartment_rents, args.house_rents, args.raw_root, args.date)
        if args.rates:
            result["rates"] = L.land_rates(spark, args.rates, args.raw_root, args.date, args.rate_type,
                                           fallback_rate=args.fallback_rate)
    elif args.cmd == "daily-incremental":
        result = D.run_daily_incremental(spark, args.raw_root, args.lake_root, args.date, args.date,
                                         rent_source_year=args.rent_source_year,
                                         rates_json_array=args.rates_json_array,
                                         fallback_rate=args.fallback_rate)
    elif args.cmd == "daily":
        result = D.run_daily(spark, args.raw_root, args.lake_root, args.date, args.date,
                             snapshot=args.snapshot, rent_source_year=args.rent_source_year,
                             years=args.years, departments=args.departments,
                             rates_json_array=args.rates_json_array, fallback_rate=args.fallback_rate)
    else:
        est = R.read_estimates(spark, args.estimates)
        if args.cmd == "value":
            out = VAL.value_listings(_read_table(spark, args.listings), bounds=args.bounds,
                                     reference=VAL.prepared_reference(est))
            result = {"listings": SK.write_parquet(out, args.out, stage="verdicts")}
        elif args.cmd == "communes":
            result = {"communes": SK.write_parquet(VAL.list_communes(est, args.date), args.out, stage="communes")}
        elif args.cmd == "profiles":
            result = {"communes": SK.write_parquet(VAL.market_profiles(est, args.commune, computation_date=args.date), args.out,
                                                   stage="profiles")}
        elif args.requests:
            result = EX.export_changes(est, args.out, args.index, args.previous, args.date)
        else:
            result = {"documents": SK.write_documents(est, args.out, args.index, args.date)}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    sys.exit(0 if main() is not None else 1)
