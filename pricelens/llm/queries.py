"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from pricelens.llm.bpe import DIGESTS, encode_decode
from pricelens.llm.chat import format_chats, read_back
from pricelens.llm.common import new_path, table, written
from pricelens.llm.conversation_repair import damage, digests, repair
from pricelens.llm.exact_dedup import exact_dedup
from pricelens.llm.language_id import identify_languages, learn
from pricelens.llm.lexical_search import search
from pricelens.llm.packing import pack
from pricelens.llm.quality_classifier import ratings_of, score, train
from pricelens.llm.quality_rules import quality_rules
from pricelens.llm.simhash import simhash_dedup
from pricelens.llm.token_counts import token_counts
from pricelens.llm.toxicity import toxicity
from pricelens.llm.warc import parse, records_of, resolve


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), max_len=2048, end_id=0)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one whose texts look like another template's control strings."""
    text = "</s>[INST] ok [/INST]"
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return read_back(format_chats(convs.unionByName(extra), path), path)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two Python stages and their word lists share an executor: small batches between them, in this query alone.
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(16 << 20))
    try:
        return written(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                     public_tokenizers.PATTERN, each=DIGESTS), "encoded")
    finally:
        spark.conf.set(setting, before)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, ratings_of(table(spark, sf_dir, "labels")), grades=3))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of every page, and of one URL that a third of the pages share, written as WARC records, parsed and resolved."""
    found = resolve(written(parse(records_of(table(spark, sf_dir, "pages"))), "records"))
    return found.select(
        F.expr("cast(substring(record_id, 2, 20) as bigint)").alias("page_id"), F.left("record_id", F.lit(1)).alias("capture"),
        "canonical_url", "outcome", F.expr("cast(substring(response_id, 2, 20) as bigint)").alias("response_page_id"),
        F.left("response_id", F.lit(1)).alias("response_capture"),
        F.col("headers")["etag"].alias("etag"), F.col("headers")["date"].alias("date"),
        F.col("headers")["content-type"].alias("content_type"), "body_sha256")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one cache: an earlier landing of a sixteenth of the documents, then all of them.

    The second run finds the first one's counts stored (of its texts and all their copies), encodes each
    other distinct text once and appends it; its rows are the result."""
    docs, path, cache = table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), new_path(spark, "token-cache")
    token_counts(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(16)) == 0), path, cache, limit=1024)
    return token_counts(docs, path, cache, limit=1024)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_languages(docs, learn(docs))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by its rows' hashes, repaired."""
    convs = table(spark, sf_dir, "conversations")
    return digests(*repair(damage(convs), originals=convs.select("conv_id"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_chat": op2_chat,
    "op3_bpe": op3_bpe,
    "op4_simhash": op4_simhash,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_token_counts": op9_token_counts,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_language_id": op11_language_id,
    "op12_lexical_search": op12_lexical_search,
    "op13_conversation_repair": op13_conversation_repair,
}
