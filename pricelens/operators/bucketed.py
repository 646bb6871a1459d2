"""Listings and estimates stored alike, for repeated valuations beyond the broadcast limit.

Both tables are bucketed and sorted on the three lookup keys and a copy number, so the join
of a valuation reads matching buckets and exchanges nothing, however often estimates are
valued against. A segment with more than ``hot_rows`` listings would fill one bucket: its
listings are dealt over copies 0, 1, 2, … and its reference row is stored once a copy. Other
segments have copy 0 alone.

Listings are shuffled once, when they are stored. The tables live in the session's catalog
(with a metastore, across sessions) and their files where the caller says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.operators import valuation as VAL
from pricelens.operators.joins import size_checked_side, written
from pricelens.operators.valuation import COPY, LOOKUP

HOT_ROWS = 2_000_000
_KEYS = [*LOOKUP, COPY]


def _store(df: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """One file a bucket, so that reading a bucket is one sequential scan."""
    (df.repartition(buckets, *_KEYS).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *_KEYS).sortBy(*_KEYS).saveAsTable(name))
    return df.sparkSession.table(name)


def _hot(listings: DataFrame, hot_rows: int) -> DataFrame:
    """The segments of more than ``hot_rows`` listings and their number of copies: at most one row for every
    ``hot_rows`` listings."""
    return listings.dropna(subset=LOOKUP).groupBy(*LOOKUP).agg(F.ceil(F.count(F.lit(1)) / hot_rows).alias("_copies")).filter(
        F.col("_copies") > 1)


def store_listings(listings: DataFrame, name: str, path: str, buckets: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Write the listings as the bucketed table ``name``, its files under ``path/listings`` and the copies of its hot
    segments under ``path/hot``. All rows are kept; those with a NULL key, which match nothing, are dealt over the
    buckets."""
    held = written(listings, "listings")  # counted, then dealt
    _hot(held, hot_rows).write.mode("overwrite").parquet(path + "/hot")
    hot, _ = size_checked_side(_read_hot(listings.sparkSession, path))
    # Dealt in turn within a task of the scan (the same rows in the same order if it is run again): equal rows part
    # as well, and every task spreads its own.
    turn = F.col("_turn")
    unkeyed = F.greatest(*[F.col(k).isNull() for k in LOOKUP])
    copy = F.when(unkeyed, turn % buckets).otherwise(turn % F.coalesce("_copies", F.lit(1)))
    dealt = held.withColumn("_turn", F.monotonically_increasing_id()).join(hot, LOOKUP, "left").withColumn(COPY, copy.cast("int"))
    return _store(dealt.drop("_copies", "_turn"), name, path + "/listings", buckets)


def _read_hot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("commune_code string, property_type string, rooms_bucket string, _copies long").parquet(path + "/hot")


def store_reference(estimates: DataFrame, name: str, path: str, listings_path: str, buckets: int) -> DataFrame:
    """Write the lookup side of a valuation as the bucketed table ``name`` (files under ``path``), a row for each
    copy that the listings stored under ``listings_path`` have of its segment. ``buckets`` is that of the listings."""
    hot = _read_hot(estimates.sparkSession, listings_path)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)).cast("int") - 1))
    return _store(VAL.reference_rows(estimates).join(hot, LOOKUP, "left").withColumn(COPY, copies).drop("_copies"),
                  name, path, buckets)


def value_stored(listings: DataFrame, reference: DataFrame, bounds: str = "quote") -> DataFrame:
    """``value_listings`` of two stored tables: buckets are merged where they lie."""
    return VAL.value_listings(listings, reference=reference.hint("merge"), bounds=bounds)
