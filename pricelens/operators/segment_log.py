"""The stored segment state: a log of count deltas with compaction.

``root`` holds three tables, each in folders ``kind=delta|base/run=r<run>``:

* ``files``: what a run added (sign 1) and withdrew (sign -1), one row per landed file. It is
  written last: a run counts once its files are there, and writing a run again replaces it.
* ``bins``: signed counts and sums per (segment, price bin) -- small, read whole.
* ``prices``: signed counts per (file, segment, price), in folders by segment bucket and price
  span, of which statistics open those that hold a target bin.

A delta holds the sales of its run alone, so a run writes in proportion to new sales. A file that
is gone is withdrawn by rows with the opposite counts, made from the rows that it had left.
``compact`` folds all runs up to one into a base, where withdrawn files no longer appear; runs
before it are not read any more.

Runs are named by texts that sort as they follow (dates, zero-padded numbers).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import contracts as C
from pricelens.operators import market as MKT
from pricelens.operators.joins import size_checked_side
from pricelens.sinks import ensure_folder
from pricelens.sources.readers import partition_values

#: Segment buckets, and price bins in a span: folders of the price rows.
BUCKETS = 4
SPAN = 32

_KEYS = [f for f in C.ESTIMATES.fields if f.name in MKT.KEYS]
_LONG, _DOUBLE = T.LongType(), T.DoubleType()
_PARTS = [T.StructField("kind", T.StringType()), T.StructField("run", T.StringType())]
_PRICES = T.StructType([*_KEYS, T.StructField("_bin", _LONG), T.StructField("price_per_m2", _DOUBLE), T.StructField("_ids", _LONG),
                        T.StructField("_rows", _LONG), T.StructField("_file", _LONG), *_PARTS,
                        T.StructField("_bucket", T.IntegerType()), T.StructField("_span", T.IntegerType())])
_BINS = T.StructType([*_KEYS, T.StructField("_bin", _LONG), *[T.StructField(c, _LONG) for c in ("_ids", "_all", "_c")],
                      T.StructField("_sum", T.DecimalType(38, 2)), T.StructField("_beyond", _DOUBLE),
                      T.StructField("_large", _LONG), *_PARTS])
_FILES = T.StructType([T.StructField("file", _LONG), T.StructField("sign", T.IntegerType()), *_PARTS])
#: The columns that a run's rows have.
ROWS = [*MKT.KEYS, *MKT.HISTOGRAM, "_file"]


def _bucket(prefix: str = "") -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"{prefix}{k}") for k in MKT.KEYS]), F.lit(BUCKETS)).cast("int")


def _span(bin_: str) -> Column:
    return F.floor(F.col(bin_) / SPAN).cast("int")


@dataclass(frozen=True)
class State:
    """The runs of a log that make up the state: a base, if there is one, and the deltas after it."""

    spark: SparkSession
    root: str
    runs: tuple[tuple[str, str], ...]  # (kind, run)

    def _read(self, table: str, schema: T.StructType, runs=None) -> DataFrame:
        paths = [f"{self.root}/{table}/kind={k}/run=r{r}" for k, r in (self.runs if runs is None else runs)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", f"{self.root}/{table}").schema(schema).parquet(*paths)

    def files(self) -> DataFrame:
        """file: the landed files whose sales the state holds."""
        return self._read("files", _FILES).groupBy("file").agg(F.sum("sign").alias("n")).where(F.col("n") > 0).select("file")

    def bins(self) -> DataFrame:
        """The bins of the whole state, one row per (segment, bin)."""
        return MKT.merge_bins(self._read("bins", _BINS).drop("kind", "run"))

    def prices(self, targets: DataFrame | None = None) -> DataFrame:
        """The price rows; with target bins, those of the folders that hold one.

        The folders are named to the scan: at most ``BUCKETS`` times the spans in use."""
        rows = self._read("prices", _PRICES)
        if targets is None:
            return rows
        wanted: dict[int, list[int]] = {}
        for r in targets.select(_bucket("_t_").alias("b"), _span("_t_bin").alias("s")).distinct().collect():
            wanted.setdefault(r["b"], []).append(r["s"])
        hit = F.lit(False)
        for bucket, spans in sorted(wanted.items()):
            hit = hit | ((F.col("_bucket") == bucket) & F.col("_span").isin(sorted(spans)))
        return rows.where(hit)

    def withdrawn(self, gone: DataFrame) -> DataFrame:
        """Rows (``ROWS``) that take back what the files ``gone`` (file) left in the state.

        Only the runs that hold one of them are opened. The files are broadcast behind a size check: dealt out
        by file, all price rows of one file would meet in one task."""
        gone, _ = size_checked_side(gone, name="files-gone")
        holding = self._read("files", _FILES).join(gone, "file", "left_semi").select("kind", "run").distinct().collect()
        runs = [(r["kind"], r["run"][1:]) for r in holding]
        rows = self._read("prices", _PRICES, runs).join(gone.withColumnRenamed("file", "_file"), "_file", "left_semi")
        keys = [*MKT.KEYS, "_bin", "price_per_m2", "_file"]
        held = rows.groupBy(*keys).agg(F.sum("_ids").alias("_ids"), F.sum("_rows").alias("_rows")).where(F.col("_rows") != 0)
        return held.select(*keys, (-F.col("_ids")).alias("_ids"), (-F.col("_rows")).alias("_rows")).select(*ROWS)

    def stats(self) -> DataFrame:
        """Segment statistics (same columns as ``market.segment_stats``)."""
        return MKT.stats_from_bins(MKT.written(self.bins(), "state-bins"), self.prices)


def runs(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(kind, run) of every run that counts, from a listing."""
    ensure_folder(spark, f"{root}/files")  # so a new log lists an empty folder
    paths = partition_values(spark, f"{root}/files").select(
        F.regexp_extract("path", r"/kind=(\w+)/run=r([^/]+)/[^/]+$", 1).alias("kind"),
        F.regexp_extract("path", r"/kind=(\w+)/run=r([^/]+)/[^/]+$", 2).alias("run")).where("kind <> ''").distinct()
    return sorted((r["kind"], r["run"]) for r in paths.collect())


def state(spark: SparkSession, root: str, before: str | None = None, through: str | None = None) -> State:
    """The state up to a run: the newest base and the deltas after it, all ``before`` or ``through`` a run."""
    known = [(k, r) for k, r in runs(spark, root) if (before is None or r < before) and (through is None or r <= through)]
    base = max((r for k, r in known if k == "base"), default=None)
    deltas = [(k, r) for k, r in known if k == "delta" and (base is None or r > base)]
    return State(spark, root, tuple(([("base", base)] if base is not None else []) + deltas))


def _put(spark: SparkSession, root: str, kind: str, run: str, rows: DataFrame, files: DataFrame) -> int:
    """Write one run: prices, then bins from them, then the files, which make it count."""
    from pricelens.sinks import write_parquet

    if not re.fullmatch(r"[\w.:-]+", run):
        raise ValueError(f"not the name of a run: {run!r}")
    at = f"kind={kind}/run=r{run}"
    placed = rows.select(*ROWS, _bucket().alias("_bucket"), _span("_bin").alias("_span"))
    # A hot (bucket, span) is split over several tasks, small ones share a task.
    n = write_parquet(placed.hint("rebalance", "_bucket", "_span"), f"{root}/prices/{at}", partition_by=["_bucket", "_span"],
                      stage="state_prices")
    MKT.price_bins(State(spark, root, ((kind, run),)).prices()).write.mode("overwrite").parquet(f"{root}/bins/{at}")
    files.select(F.col("file").cast("long"), F.col("sign").cast("int")).write.mode("overwrite").parquet(f"{root}/files/{at}")
    return n


def append(spark: SparkSession, root: str, run: str, rows: DataFrame, files: DataFrame) -> int:
    """Add a run's signed rows (``ROWS``) and files (file, sign); replaces the run if it is there.

    Later runs were made against this one's files, so it must be the last. Returns the price rows written."""
    later = [r for _, r in runs(spark, root) if r > run]
    if later:
        raise ValueError(f"{root}: run {run} comes before stored run {max(later)}")
    if ("base", run) in runs(spark, root):
        raise ValueError(f"{root}: run {run} is part of a base")
    return _put(spark, root, "delta", run, rows, files)


def compact(spark: SparkSession, root: str, through: str | None = None) -> str | None:
    """Fold the newest base and the deltas after it, up to ``through`` (the last run by default), into a new base.

    One pass over the price rows, a shuffle by file and price; rows that cancel out and withdrawn files
    are left out. Returns the base's run; None if there is nothing to fold."""
    old = state(spark, root, through=through)
    if not any(k == "delta" for k, _ in old.runs):
        return None
    run = old.runs[-1][1]
    rows = old.prices().groupBy(*MKT.KEYS, "_bin", "price_per_m2", "_file").agg(
        F.sum("_ids").alias("_ids"), F.sum("_rows").alias("_rows")).where((F.col("_rows") != 0) | (F.col("_ids") != 0))
    _put(spark, root, "base", run, rows, old.files().withColumn("sign", F.lit(1)))
    return run
