"""Landing jobs: source files as they are published -> the raw folders the daily run reads.

Files are already local (or on any storage Spark reads); nothing is downloaded. Each job
is one scan and one write into an ``ingestion_date=`` folder and returns the rows landed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens import sinks as SK
from pricelens.operators import formatting as FMT
from pricelens.sources import readers as R


def land_sales(spark: SparkSession, paths, raw_root: str, ingestion_date: str, sep: str = "|",
               skipped: list | None = None) -> int:
    """SRC-4 + SET-1 + SRC-12 + SNK-3: department files (pipe-delimited, each with its own header) ->
    one landing of the whitelisted columns. Missing paths and bad files are skipped whole and
    appended to ``skipped``; the lines that made files bad land in ``rejects/dvf`` (file, line,
    reason) of the same ingestion date."""
    skipped = [] if skipped is None else skipped
    raw, rejects = R.read_quarantined_csv(spark, paths, sep=sep, skipped=skipped)
    if skipped:
        SK.land_json(rejects, f"{raw_root}/rejects/dvf", ingestion_date, stage="rejected_lines")
    for c in C.RAW_SALES_COLUMNS:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    return SK.land_csv(raw.select(*C.RAW_SALES_COLUMNS), f"{raw_root}/dvf", ingestion_date, stage="land_sales")


def land_rents(spark: SparkSession, apartment: str, house: str, raw_root: str, ingestion_date: str) -> int:
    """SRC-5 + JOIN-2 + SNK-3: the apartment and the house indicator file, each read with its
    own delimiter -> one merged landing."""
    merged = FMT.merge_rents(R.read_csv_detected(spark, apartment), R.read_csv_detected(spark, house))
    return SK.land_csv(merged, f"{raw_root}/rents", ingestion_date, sep=";", stage="land_rents")


def land_rates(spark: SparkSession, paths, raw_root: str, ingestion_date: str,
               rate_type: str = R.FALLBACK_RATE_TYPE, source: str = R.FALLBACK_SOURCE,
               fallback_rate: float | None = R.FALLBACK_RATE) -> int:
    """SRC-6 + SRC-10 + SNK-4: rate-service responses (one SDMX-JSON document a file) -> rate
    records; a single fallback row dated the ingestion date if they hold none. ``paths`` of one
    ``rate_type``, or a dict of paths by rate type: all land together, as one ingestion date."""
    rates = None
    for kind, where in (paths if isinstance(paths, dict) else {rate_type: paths}).items():
        docs = spark.read.text(where, wholetext=True)
        parsed = R.parse_sdmx(docs, "value", F.lit(kind), F.lit(source))
        rates = parsed if rates is None else rates.unionByName(parsed)
    if rates is None:
        raise ValueError("no rate documents were named")
    if fallback_rate is not None:
        rates = R.with_fallback_row(rates, ingestion_date, fallback_rate, rate_type, source)
    return SK.land_json(rates, f"{raw_root}/rates", ingestion_date, stage="land_rates")
