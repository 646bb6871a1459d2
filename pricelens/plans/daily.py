"""The daily run: raw -> formatted -> usage.

``estimates`` is the whole computation as one lazy lineage over the driver's tables;
``run_daily`` runs it over landed files with a written formatted layer and stage
counts; ``run_daily_incremental`` processes what changed among the landings since its
stored state.

Steps 4 and 5 of the reference (combine, then enrich in place) fuse into one plan
with one write, so the read-back / temp-directory / move dance disappears.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.operators import formatting as FMT
from pricelens.operators import market as MKT
from pricelens.sources import fixtures as FX

log = logging.getLogger(__name__)

# Fixed run parameters so results are reproducible (dates are arguments, never today()).
COMPUTATION_DATE = "2024-12-31"
INGESTION_DATE = "2024-12-31"


def formatted_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FMT.format_sales(FX.raw_sales(spark, sf_dir))


def formatted_rents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FMT.format_rents(FX.raw_rents(spark, sf_dir))


def formatted_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FMT.format_rates(FX.raw_rates(spark, sf_dir), INGESTION_DATE)


def estimates(spark: SparkSession, sf_dir: str, exact: bool = False,
              computation_date: str = COMPUTATION_DATE) -> DataFrame:
    """The 16-column usage table from the driver's tables."""
    return MKT.fair_price_estimates(formatted_sales(spark, sf_dir), formatted_rents(spark, sf_dir),
                                    formatted_rates(spark, sf_dir), computation_date, exact=exact)


def _landed(spark: SparkSession, path: str, read):
    """SRC-9: a source with no folder yet or no landed rows gives None, so the caller skips
    it -- nothing is written for it and earlier results stay in place. Any other trouble
    (permissions, a folder without ``ingestion_date=`` parts, a broken file) is raised."""
    from pricelens.sources import readers as R
    if not R.path_exists(spark, path):
        log.warning("nothing landed under %s", path)
        return None
    df = read()
    return df if R.has_rows(df) else None


def _until(df: DataFrame, run_date: str) -> DataFrame:
    """Landings up to the run date; the predicate prunes ``ingestion_date=`` folders."""
    if "ingestion_date" not in df.columns:
        return df
    return df.filter(F.col("ingestion_date") <= F.lit(run_date).cast("date"))


def _rates(spark: SparkSession, raw_root: str, ingestion_date: str, schema, array: bool | None,
           fallback_rate: float | None, fallback_rate_type: str | None = None,
           fallback_source: str | None = None) -> DataFrame | None:
    """WIN-1 over the formatted rate landings up to the run date: one row per rate type.

    SRC-10: without a usable rate the fallback row dated the ingestion date stands in;
    without a fallback, no landed rows give None, and rows of which none is usable raise
    (a misread file must not pass for a day without rates)."""
    from pricelens import contracts as C
    from pricelens.sources import readers as R
    path = f"{raw_root}/rates"
    raw = _landed(spark, path, lambda: _until(R.read_json_records(
        spark, path, schema or C.RAW_RATES, multiline=array), ingestion_date))
    if raw is not None:
        rates = FMT.latest_rates_per_type(FMT.format_rates(raw, ingestion_date))
        if R.has_rows(rates):
            return rates
        if fallback_rate is None:
            raise ValueError(f"{path}: rows landed, but no usable rate among them")
    if fallback_rate is None:
        return None
    one = R.with_fallback_row(spark.createDataFrame([], C.RAW_RATES), ingestion_date, fallback_rate,
                              fallback_rate_type or R.FALLBACK_RATE_TYPE, fallback_source or R.FALLBACK_SOURCE)
    return FMT.latest_rates_per_type(FMT.format_rates(one, ingestion_date))


def run_daily(spark: SparkSession, raw_root: str, lake_root: str, computation_date: str,
              ingestion_date: str, snapshot: str = "all", rates_schema=None,
              rent_source_year: int | None = None, years=None, departments=None,
              rates_json_array: bool | None = None, fallback_rate: float | None = None,
              fallback_rate_type: str | None = None,
              fallback_source: str | None = None) -> dict[str, int]:
    """The daily run over landed files: raw -> formatted layer -> usage table.

    ``raw_root`` holds ``dvf/`` and ``rents/`` (CSV landings) and ``rates/`` (JSON
    landings: arrays or one record per line, told apart by their first line unless
    ``rates_json_array`` says which), each in ``ingestion_date=`` folders, of which those up
    to ``ingestion_date`` are read. Each formatted table is written once (sales by year,
    rents by edition, the newest rate of each type) and read back, which cuts the
    lineage between stages; the usage table is written by computation date with dynamic
    overwrite, so earlier runs stay next to it. ``years`` / ``departments`` scope the
    sales that feed the segments; ``fallback_rate`` stands in when no rate was landed.
    Returns the row count of every stage and reject reason,
    gathered by ``observe`` on the writes (no extra passes); they are also stored in ``ledger``.
    """
    from pricelens import contracts as C
    from pricelens import sinks as SK
    from pricelens.sources import readers as R

    counts: dict[str, int] = {}
    fmt_root, usage = f"{lake_root}/formatted", f"{lake_root}/usage/fair_price_estimates"

    raw_sales = _landed(spark, f"{raw_root}/dvf", lambda: _until(
        R.read_landed_csv(spark, f"{raw_root}/dvf", snapshot=snapshot), ingestion_date))
    if raw_sales is not None:
        sales, obs_sales = FMT.format_sales_counted(raw_sales)
        counts["formatted_sales"] = SK.write_parquet(sales, f"{fmt_root}/sales",
                                                     partition_by=["year"], stage="formatted_sales")
        counts["raw_sales"] = SK.rows_of(obs_sales)
        for reason in FMT.REJECT_REASONS:
            counts[f"rejected_sales:{reason}"] = int(obs_sales.get[reason])

    raw_rents = _landed(spark, f"{raw_root}/rents", lambda: _until(
        R.read_csv_detected(spark, f"{raw_root}/rents", snapshot=snapshot), ingestion_date))
    if raw_rents is not None:  # delimiter sniffed per file
        counts["formatted_rents"] = SK.write_parquet(FMT.format_rents(raw_rents, rent_source_year),
                                                     f"{fmt_root}/rents", partition_by=["source_year"],
                                                     stage="formatted_rents")

    rates = _rates(spark, raw_root, ingestion_date, rates_schema, rates_json_array, fallback_rate,
                   fallback_rate_type, fallback_source)
    if rates is not None:
        counts["formatted_rates"] = SK.write_parquet(rates, f"{fmt_root}/rates", stage="formatted_rates")

    # FLT-13: the configured scope; on the year-partitioned table it prunes partitions.
    sales = FMT.scope_sales(spark.read.parquet(f"{fmt_root}/sales"), years, departments)
    est = MKT.fair_price_estimates(sales, spark.read.parquet(f"{fmt_root}/rents"),
                                   spark.read.parquet(f"{fmt_root}/rates"), computation_date)
    counts["segments"] = SK.write_parquet(est, usage, partition_by=["computation_date"], dynamic=True,
                                          stage="segments")
    _write_ledger(spark, f"{lake_root}/ledger", computation_date, counts)
    return counts


def _write_ledger(spark: SparkSession, path: str, computation_date: str, counts: dict[str, int]) -> None:
    """AGG-9: the counts of a run as a table (stage, n_rows), one folder a date, after the invariant
    raw = formatted + rejects by reason has been checked."""
    from pricelens import sinks as SK
    if "raw_sales" in counts:
        rejected = sum(n for k, n in counts.items() if k.startswith("rejected_sales:"))
        if counts["raw_sales"] != counts["formatted_sales"] + rejected:
            raise RuntimeError(f"sales are not conserved: {counts}")
    rows = spark.createDataFrame([(computation_date, k, n) for k, n in counts.items()],
                                 "computation_date string, stage string, n_rows long")
    SK.write_parquet(rows, path, partition_by=["computation_date"], dynamic=True, stage="ledger")


def run_daily_incremental(spark: SparkSession, raw_root: str, lake_root: str, computation_date: str,
                          ingestion_date: str, rates_schema=None,
                          rent_source_year: int | None = None,
                          rates_json_array: bool | None = None,
                          fallback_rate: float | None = None, compact_after: int = 30) -> dict[str, int]:
    """The daily run over what changed among the landed sales files; equal to ``run_daily`` over all
    landings up to the run date.

    The state is a log (``operators/segment_log.py``) that records the landed files it holds. Files
    landed since -- whatever date their folder bears, so late landings too -- are formatted and their
    counts appended; files that are gone, as after landing a date again, are withdrawn. What is written
    grows with these files, what is read with them, the bins and the price folders that hold a
    quantile. Every ``compact_after`` runs the log is folded into a base, one pass over all price rows.
    A rerun of the last date replaces its run; an earlier date than the last raises. A landing root
    without any file changes nothing. All rent editions and rate landings up to the run date are
    read: both are small.
    """
    from pricelens import contracts as C
    from pricelens import sinks as SK
    from pricelens.operators import segment_log as LOG
    from pricelens.sources import readers as R

    root, sales_root = f"{lake_root}/state/segments", f"{raw_root}/dvf"
    usage = f"{lake_root}/usage/fair_price_estimates"
    counts: dict[str, int] = {}

    old = LOG.state(spark, root, before=computation_date)
    known = MKT.written(old.files(), "known-files")
    new, gone = [], known.limit(0)
    if R.path_exists(spark, sales_root):
        listing = MKT.written(R.landed_files(spark, sales_root), "landed-files")
        new = _until(listing, ingestion_date).join(known, "file", "left_anti").select(
            "file", "path").collect()  # the names of files landed since the last run
        if R.has_rows(listing):
            gone = known.join(listing, "file", "left_anti")
    if not new and not old.runs:
        raise ValueError(f"no sales landed under {sales_root} and no stored segment state")
    changes = old.withdrawn(gone)
    if new:
        fresh = R.with_file(R.read_landed_csv(spark, sales_root, files=[r["path"] for r in new]))
        sales = FMT.format_sales(fresh, keep=["_file"])
        changes = changes.unionByName(MKT.histogram_rows(sales, ["_file"]).select(*LOG.ROWS))
    files = spark.createDataFrame([(r["file"], 1) for r in new], "file long, sign int").unionByName(
        gone.select("file", F.lit(-1).alias("sign")))
    counts["state"] = LOG.append(spark, root, computation_date, changes, files)
    now = LOG.state(spark, root, through=computation_date)

    raw_rents = _landed(spark, f"{raw_root}/rents", lambda: _until(
        R.read_csv_detected(spark, f"{raw_root}/rents"), ingestion_date))
    rents = (FMT.format_rents(raw_rents, rent_source_year) if raw_rents is not None
             else spark.createDataFrame([], C.RENTS))  # no rent file: rents stay NULL
    rates = _rates(spark, raw_root, ingestion_date, rates_schema, rates_json_array, fallback_rate)
    if rates is None:
        rates = spark.createDataFrame([], C.RATES)
    est = MKT.estimates_from_segments(now.stats(), rents, rates, computation_date)
    counts["estimates"] = SK.write_parquet(est, usage, partition_by=["computation_date"], dynamic=True,
                                           stage="estimates")
    # The newest run stays a delta, so that it can be run again; those before it are folded.
    if len(old.runs) >= compact_after:
        LOG.compact(spark, root, through=old.runs[-1][1])
    return counts
