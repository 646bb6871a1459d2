"""Sinks: Parquet / CSV / JSON / document exports, each one write with counted rows.

Row counts per stage (AGG-9) ride on the write through ``DataFrame.observe``: no extra
``count()`` pass over the data.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pricelens.operators.valuation import latest_run

log = logging.getLogger(__name__)

DEFAULT_INDEX = "fair_price_estimates"


def counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """AGG-9: attach a row counter that is filled when ``df`` is next executed."""
    obs = Observation(stage)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def rows_of(obs: Observation) -> int:
    """The rows that ``counted`` saw; a count that was lost is an error, not an empty stage."""
    seen = obs.get
    if "rows" not in seen:
        raise RuntimeError("the row count of a stage was lost; its output cannot be vouched for")
    return int(seen["rows"])


def _norm(p: str) -> str:
    p = p.rstrip("/")
    for prefix in ("file://", "file:"):
        if p.startswith(prefix):
            p = p[len(prefix):]
    return p


def input_roots(df: DataFrame) -> list[str]:
    """The root paths of the files a plan reads (folders as given to the reader, not their files)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(relation := leaf.relation(), "location"):
            paths = relation.location().rootPaths()
            roots += [paths.apply(k).toString() for k in range(paths.size())]
    return roots


def guard_not_input(df: DataFrame, path: str) -> None:
    """SNK-2: refuse to overwrite a dataset the plan is reading (Spark would delete the
    input before reading it). Checked from the plan's root paths, not its file listing."""
    target = _norm(path) + "/"
    for root in input_roots(df):
        root = _norm(root) + "/"
        if root.startswith(target) or target.startswith(root):
            raise ValueError(f"refusing to overwrite {path}: it is an input of this plan")


def write_parquet(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite",
                  dynamic: bool = False, stage: str = "parquet") -> int:
    """SNK-1: Parquet (Snappy), partitioned; static overwrite replaces the dataset,
    ``dynamic=True`` replaces only the partitions being written. Returns rows written."""
    guard_not_input(df, path)
    out, obs = counted(df, stage)
    w = out.write.mode(mode).option("compression", "snappy")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    n = rows_of(obs)
    log.info("%s: %d rows -> %s", stage, n, path)
    return n


def land_csv(df: DataFrame, path: str, ingestion_date, sep: str = ",", stage: str = "land_csv") -> int:
    """SNK-3: header CSV in an ``ingestion_date=`` partition (re-landing a date replaces
    only that date)."""
    out, obs = counted(df, stage)
    out = out.withColumn("ingestion_date", F.lit(str(ingestion_date)))  # last: a constant that Spark sees needs no sort
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", True).option("sep", sep).partitionBy("ingestion_date").csv(path))
    return rows_of(obs)


def land_json(df: DataFrame, path: str, ingestion_date, stage: str = "land_json") -> int:
    """SNK-4: JSON records (one per line) in an ``ingestion_date=`` partition."""
    out, obs = counted(df, stage)
    out = out.withColumn("ingestion_date", F.lit(str(ingestion_date)))  # last: a constant that Spark sees needs no sort
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingestion_date").json(path))
    return rows_of(obs)


def documents(df: DataFrame, index: str = DEFAULT_INDEX, computation_date=None) -> DataFrame:
    """SNK-5 + PRJ-24: one JSON document per row of one run (``latest_run``), NULL fields
    dropped, dates as ``yyyy-MM-dd``, with the target index name attached."""
    df = latest_run(df, computation_date)
    return df.select(F.lit(index).alias("_index"),
                     F.to_json(F.struct(*df.columns), {"dateFormat": "yyyy-MM-dd"}).alias("_source"))


def write_documents(df: DataFrame, path: str, index: str = DEFAULT_INDEX, computation_date=None) -> int:
    """Bulk-loadable export of one run: newline-delimited ``{"_index":…, "_source":{…}}`` records."""
    df = latest_run(df, computation_date)
    record = F.struct(F.lit(index).alias("_index"), F.struct(*df.columns).alias("_source"))
    docs = df.select(F.to_json(record, {"dateFormat": "yyyy-MM-dd"}).alias("value"))
    out, obs = counted(docs, "documents")
    out.write.mode("overwrite").text(path)
    return rows_of(obs)


def ensure_folder(spark, path: str) -> None:
    """Create ``path`` if it does not exist, on any file system Spark writes to: an empty
    hidden ``_created`` marker (ignored by every Spark reader) is written inside it, once."""
    spark.range(0).selectExpr("cast(id as string) as value").write.mode("ignore").text(
        f"{path.rstrip('/')}/_created")
