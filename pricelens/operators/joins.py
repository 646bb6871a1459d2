"""Join helpers: a broadcast only behind a size check, with a shuffle join beyond it.

A side whose size is bounded by the number of segments has that bound from the domain, not
from the data. So it is written once as Parquet (in the cluster's shared
``spark.checkpoint.dir``; this also cuts its lineage, so a lost executor never recomputes the
aggregation), measured, and hinted for broadcast only when rows and bytes are within
``BROADCAST_MAX_ROWS`` and ``BROADCAST_MAX_BYTES``. Above that the join is left to a shuffle
join, where AQE splits skewed keys.

Without the hint, the static planner cannot know that an aggregate of a huge table is
small; AQE would switch to a broadcast only after the large side had already been
shuffle-written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pricelens.session import scratch_path

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 128 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet, and a DataFrame over it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_checked_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES, name: str = "join-side") -> tuple[DataFrame, bool]:
    """Write ``df``; return it broadcast-hinted when it has at most ``max_rows`` rows
    and ``max_bytes`` bytes (and whether the hint was given). Rows and bytes are observed
    while it is written, so the check costs no extra pass; without the observation there
    is no hint."""
    obs = Observation("size_check")
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() == "string"]
    width = sum(strings, F.lit(16 + 8 * len(df.columns)))
    m = written(df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")), name)
    seen = obs.get
    small = "rows" in seen and int(seen["rows"]) <= max_rows and int(seen.get("bytes") or 0) <= max_bytes
    return (F.broadcast(m) if small else m), small
