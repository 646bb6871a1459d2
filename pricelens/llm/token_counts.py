"""Token counts through a digest cache.

The cache is a Parquet folder of (tokenizer, content, n_tokens): the digest of the
tokenizer version, the SHA-256 of the normalised content (UTF-8, null as empty; nothing
that could change the count is altered) and the count. A run digests every text where it
is read, looks the digests up, encodes each missing text once, appends the new counts and
joins all counts back to the rows by digest. With no cache yet each distinct text moves
once; with one, digests are looked up first and texts meet the missing digests by a join,
so only those are encoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import texts, written
from pricelens.llm.tokens import encoder, version_digest

CACHE = "tokenizer string, content string, n_tokens long"


def _cached(docs: DataFrame, path: str, tokenizer: str) -> DataFrame | None:
    """content and n_tokens of this tokenizer version, one row per content; None: no cache yet."""
    spark = docs.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    rows = spark.read.schema(CACHE).parquet(path).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))  # two writers may have met


def _misses(docs: DataFrame, digests: DataFrame, cached: DataFrame | None, id_col: str, text_col: str) -> DataFrame:
    """content and text of each distinct text without a count; copies meet on the map side first."""
    rows = texts(docs, id_col, text_col).select(F.sha2("text", 256).alias("content"), "text")
    if cached is not None:
        missing = written(digests.select("content").distinct().join(cached, "content", "left_anti"), "missing")
        rows = rows.join(missing, "content", "left_semi")
    return rows.distinct()


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Null text counts as empty (no tokens). Repeated rows and a null id keep their rows; an
    empty table gives an empty result and leaves the cache as it is.
    """
    spark = docs.sparkSession
    version = version_digest(tokenizer_path)
    digests = written(texts(docs, id_col, text_col).select(
        "doc_id", F.sha2("text", 256).alias("content"), F.octet_length("text").cast("long").alias("n_bytes")), "digests")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer_path).ids
        for b in batches:
            n = [len(ids(x.as_py())) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(n), pa.string()), b.column(0), pa.array(n, pa.int64())],
                ["tokenizer", "content", "n_tokens"])

    cached = _cached(docs, cache_path, version)
    misses = _misses(docs, digests, cached, id_col, text_col)
    misses.mapInArrow(counted, CACHE).write.mode("append").parquet(cache_path)
    counts = _cached(docs, cache_path, version)
    return digests.join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
