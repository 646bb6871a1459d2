"""The corpus pipeline: rules, classifier, exact and near deduplication, packing.

Every stage works on all rows its predecessor kept; all but the last return the columns
of the documents they got. ``run`` writes each stage's result as Parquet to the shared
folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.common import new_path, table, text_key
from pricelens.llm.exact_dedup import exact_dedup
from pricelens.llm.packing import pack
from pricelens.llm.quality_classifier import ratings_of, score, train
from pricelens.llm.quality_rules import quality_rules
from pricelens.llm.simhash import simhash_dedup

#: SQL cannot express the classifier's fit; the stages are tested against brute force one by one.
ORACLE_SQL = None


def _one_row_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of ``found`` (doc_id, text_key, group, keep_id a row).

    It is a row with the group's ``keep_id`` (null if no row of the group has an id); of several, the one
    with the least text key, then the least other columns. Rows of one doc_id in different groups are apart.
    """
    others = [docs[c] for c in docs.columns if c not in ("doc_id", "text")]
    tie = F.struct(docs["text"].isNull().alias("empty"), F.to_json(F.struct(F.lit(0).alias("_"), *others)).alias("others"))
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), text_key(docs["text"].cast("string")).alias("text_key"),
                       tie.alias("tie"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    chosen = (found.where("doc_id <=> keep_id").groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
              .select(F.col("one.doc_id").alias("chosen_id"), F.col("one.text_key").alias("chosen_key")))
    # Repeated rows are reduced in the map tasks, before the join: a row repeated very often is no task's load.
    distinct = rows.groupBy("id", "text_key").agg(F.min_by("row", "tie").alias("row"))
    return distinct.join(chosen, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("text_key") == F.col("chosen_key")),
                         "left_semi").select("row.*")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs, carry=True).where("kept").select("row.*")


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps; it is fitted on rated rows of the whole table, poor ones included."""
    model = train(table(spark, sf_dir, "documents"), ratings_of(table(spark, sf_dir, "labels")), grades=3)
    return score(docs, model, carry=True).where("kept").select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    found = exact_dedup(docs, keep="largest", keyed=True)
    return _one_row_of(docs, found.select("doc_id", "text_key", F.col("text_sha256").alias("group"), "keep_id"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, one with the least id, of each component of near copies."""
    found = simhash_dedup(docs, shingle=3, max_bits=3, keyed=True)
    return _one_row_of(docs, found.select("doc_id", "text_key", F.col("component").alias("group"),
                                          F.col("component_id").alias("keep_id")))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), max_len=2048, end_id=0)


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", near_stage),
    ("pack", pack_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``: one row per piece of a document that is left."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
