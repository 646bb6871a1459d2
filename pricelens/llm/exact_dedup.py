"""Exact deduplication: 128-bit content hash, stable id, byte comparison inside groups.

1. Every text is normalised and hashed (MD5, 128 bits; SHA-256 for the caller) where it
   was read; only ids and hashes are written to the shared folder.
2. Rows are grouped by (hash, normalised text). Grouping by the text itself is the byte
   comparison: Spark compares the bytes of rows with equal hashes, first inside each map
   task, so a group with a third of all rows ships one row per task, never its copies.
3. A hash with a single text (all of them, short of a collision) names its group by
   itself; the small (id, hash) rows take the result from it. Hashes with several texts
   go through a join on hash and text, so a collision never merges different texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import text_key, texts, written


def _ascii_lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pc.ascii_lower(b.column(1)), *b.columns[2:]],
                                         ["doc_id", "norm", *b.schema.names[2:]])


def normalised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lower: bool = True,
               keyed: bool = False) -> DataFrame:
    """``doc_id`` and ``norm``: the text (null: empty), lower-cased in A-Z only if ``lower``.

    With ``keyed`` also ``text_key``, the key of the text as it came.
    """
    rows = texts(docs, id_col, text_col)
    if keyed:
        rows = rows.withColumn("text_key", text_key("text"))
    if not lower:
        return rows.withColumnRenamed("text", "norm")
    return rows.mapInArrow(_ascii_lower, "doc_id long, norm string" + (", text_key binary" if keyed else ""))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                lower: bool = True, content_hash=F.md5, keyed: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    With ``keyed`` also ``text_key`` (see ``common.text_key``), which with doc_id finds the row again.

    ``keep`` names the id that stays of equal texts: ``smallest`` or ``largest``.
    ``content_hash`` maps a text column to the grouping hash (tests pass a weak one).

    Null text counts as empty. A null id never stays while its group has another id; in a
    group of null ids only, ``keep_id`` is null and the rows are kept. A repeated
    (id, text) row is a member like any other: it counts in ``group_size`` and carries the
    same answer. An empty table gives an empty result.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    key = ["text_key"] if keyed else []
    norm = normalised(docs, id_col, text_col, lower)
    rows = normalised(docs, id_col, text_col, lower, keyed)
    hashed = written(rows.select("doc_id", *key, content_hash("norm").alias("h"),
                                 F.sha2("norm", 256).alias("text_sha256")), "hashes")
    groups = (norm.select("doc_id", content_hash("norm").alias("h"), "norm")
              .groupBy("h", "norm").agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    by_hash = written(groups.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.min("keep_id").alias("keep_id"),
                                              F.sum("group_size").alias("group_size")), "groups")
    out = hashed.join(by_hash.where("texts = 1").drop("texts"), "h")
    collided = by_hash.where("texts > 1").select("h")
    if not collided.isEmpty():
        apart = rows.withColumn("h", content_hash("norm")).join(collided, "h", "left_semi")
        exact = apart.groupBy("h", "norm").agg(pick("doc_id").alias("keep_id"),
                                               F.count(F.lit(1)).alias("group_size"))
        out = out.unionByName(apart.join(exact, ["h", "norm"]).select(
            "h", "doc_id", *key, F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256", *key)
