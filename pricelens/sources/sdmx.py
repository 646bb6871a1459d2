"""SDMX-JSON documents built from rate observations (the landing format of the rate
service), so the SDMX scan (``readers.parse_sdmx``) can be run on data derived from
the driver's tables.

Each document holds one series of at most ``DOC_SIZE`` observations of one rate type:
observations are blocked by their position within their input partition
(``monotonically_increasing_id`` is the partition index plus the row position, stable
when a task is re-run), so no document -- and no task building one -- grows with the
table, even if one id or one rate type repeats across a third of all rows. Every document also carries one observation with a NULL value and one
whose index points past the period list; the scan must skip both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOC_SIZE = 256
SERIES_KEY = "0:0:0"


def pack_sdmx(obs: DataFrame, doc_size: int = DOC_SIZE) -> DataFrame:
    """(period, rate_value, rate_type, source, event_id) -> (rate_type, source, json)."""
    bucket = F.floor(F.monotonically_increasing_id() / F.lit(doc_size)).alias("_doc")
    docs = obs.groupBy("rate_type", "source", bucket).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "period", "rate_value"))).alias("o"))
    n = F.size("o")
    idx = F.transform(F.sequence(F.lit(0), n - 1), lambda i: i.cast("string"))
    keys = F.concat(idx, F.array(n.cast("string"), (n + 1).cast("string")))
    vals = F.concat(F.transform("o", lambda x: F.array(x["rate_value"])),
                    F.array(F.array(F.lit(None).cast("double")), F.array(F.lit(1.0))))
    observations = F.map_from_arrays(keys, vals)
    series = F.create_map(F.lit(SERIES_KEY), F.struct(observations.alias("observations")))
    periods = F.transform("o", lambda x: F.struct(x["period"].alias("id")))
    dims = F.array(
        F.struct(F.lit("FREQ").alias("id"), F.array(F.struct(F.lit("D").alias("id"))).alias("values")),
        F.struct(F.lit("TIME_PERIOD").alias("id"), periods.alias("values")),
    )
    doc = F.struct(F.struct(
        F.array(F.struct(series.alias("series"))).alias("dataSets"),
        F.struct(F.struct(dims.alias("observation")).alias("dimensions")).alias("structure"),
    ).alias("data"))
    return docs.select("rate_type", "source", F.to_json(doc).alias("json"))
