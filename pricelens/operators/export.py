"""The document export as bulk requests: bounded in bytes and rows, of changed documents only.

A run's documents get an id from their segment keys and a digest of their content. Two runs
meet by id, and of the earlier one only ids and digests move. Requests are cut where running
sums of bytes and rows pass a step, so no task needs to know where another one stopped. The
sums run inside parts of the id's digits: parts are even whatever the keys are, and their
number is a parameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens.operators.valuation import latest_run

#: Content that may differ between two runs without the document counting as changed.
RUN_COLUMNS = ("computation_date",)
MAX_BYTES, MAX_DOCUMENTS = 5 << 20, 1000
#: A document of more than this part of a request travels alone; the rest fill at least what is left.
ALONE = 8


def _json(columns) -> F.Column:
    return F.to_json(F.struct(*columns), {"dateFormat": "yyyy-MM-dd"})


def keyed_documents(df: DataFrame, index: str, computation_date=None, keys=C.SEGMENT_KEYS,
                    ignore=RUN_COLUMNS) -> DataFrame:
    """One document per segment of one run: _index, _id (SHA-256 of the keys), _source (as the export writes it:
    NULL fields dropped) and digest (SHA-256 of the content without ``ignore``). NULL keys are keys like any other;
    of several rows with the same keys the one whose document sorts last is kept."""
    df = latest_run(df, computation_date)
    content = [c for c in df.columns if c not in ignore]
    docs = df.select(F.sha2(_json(keys), 256).alias("_id"),
                     F.struct(_json(df.columns).alias("_source"), F.sha2(_json(content), 256).alias("digest")).alias("d"))
    return docs.groupBy("_id").agg(F.max("d").alias("d")).select(
        F.lit(index).alias("_index"), "_id", "d._source", "d.digest")


def changed_documents(now: DataFrame, before: DataFrame) -> DataFrame:
    """What turns the index of ``before`` (_index, _id, digest) into that of ``now`` (``keyed_documents``):
    _index, _id, action (``index`` for new and changed documents, ``delete`` for those gone), _source and digest
    (NULL for a deletion). Unchanged documents have no row."""
    old = before.select("_index", "_id", F.col("digest").alias("_before"))
    action = F.when(F.col("digest").isNull(), F.lit("delete")).when(
        ~F.col("digest").eqNullSafe(F.col("_before")), F.lit("index"))
    return now.join(old, ["_index", "_id"], "full_outer").withColumn("action", action).filter(
        F.col("action").isNotNull()).select("_index", "_id", "action", "_source", "digest")


def bulk_requests(changes: DataFrame, max_bytes: int = MAX_BYTES, max_documents: int = MAX_DOCUMENTS,
                  digits: int = 2) -> DataFrame:
    """Requests of at most ``max_bytes`` bytes (UTF-8) and ``max_documents`` documents: part, block (from 1 in each
    part), n_documents, n_bytes, body (newline-delimited: an action line, then the document unless it is a deletion).

    Only a document that is larger than ``max_bytes`` by itself makes a larger request. Documents over an ``ALONE``-th
    of it travel alone; the others share a request as long as they start within the same step of the running sums.
    Parts are the first ``digits`` (hexadecimal) digits of the id: each is cut in one sorted pass, so take more
    digits for more documents.
    """
    if max_bytes < ALONE or max_documents < 1:
        raise ValueError("a request holds at least one document and some bytes")
    target = F.struct("_index", "_id")
    deleted = F.col("action") == "delete"
    entry = F.when(deleted, F.concat(F.to_json(F.struct(target.alias("delete"))), F.lit("\n"))).otherwise(
        F.concat(F.to_json(F.struct(target.alias("index"))), F.lit("\n"), F.col("_source"), F.lit("\n")))
    rows = changes.select(F.substring("_id", 1, digits).alias("part"), "_id", "_index", entry.alias("entry")).withColumn(
        "size", F.octet_length("entry").cast("long"))
    shared = F.col("size") <= max_bytes // ALONE
    step = max_bytes - max_bytes // ALONE
    ahead = Window.partitionBy("part").orderBy("_id", "_index").rowsBetween(Window.unboundedPreceding, -1)

    def slot(amount, of):
        return F.floor(F.coalesce(F.sum(F.when(shared, amount)).over(ahead), F.lit(0)) / of)

    rows = rows.withColumns({"by_bytes": slot(F.col("size"), step), "by_rows": slot(F.lit(1), max_documents),
                             "alone": F.when(~shared, F.struct("_id", "_index"))})
    blocks = rows.groupBy("part", "by_bytes", "by_rows", "alone").agg(
        F.min(F.struct("_id", "_index")).alias("first"), F.count(F.lit(1)).alias("n_documents"), F.sum("size").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("_id", "_index", "entry"))).alias("entries"))
    number = F.row_number().over(Window.partitionBy("part").orderBy("first"))
    return blocks.select("part", number.alias("block"), "n_documents", "n_bytes",
                         F.array_join(F.col("entries")["entry"], "").alias("body"))


def export_changes(df: DataFrame, out: str, index: str, previous: str | None = None, computation_date=None,
                   max_bytes: int = MAX_BYTES, max_documents: int = MAX_DOCUMENTS, digits: int = 2) -> dict[str, int]:
    """Export one run to the new folder ``out``: ``requests`` (one text file a request, in ``part=``/``block=``
    folders) of what changed since the export in ``previous`` (without one: everything), and ``exported`` (_index,
    _id, digest of all documents) for the next export. ``exported`` is written last, so an export that fails can't
    be taken for a previous one. Returns the numbers of requests, documents and deletions."""
    spark = df.sparkSession
    now = keyed_documents(df, index, computation_date)
    state = "_index string, _id string, digest string"
    before = spark.read.schema(state).parquet(previous + "/exported") if previous else spark.createDataFrame([], state)
    requests = bulk_requests(changed_documents(now, before), max_bytes, max_documents, digits)
    # A text row ends in a line break of its own; the body's last one is left to it.
    requests.select("part", "block", F.expr("left(body, length(body) - 1)").alias("value")).write.mode(
        "error").partitionBy("part", "block").text(out + "/requests")
    now.select("_index", "_id", "digest").write.mode("error").parquet(out + "/exported")
    done = spark.read.schema(state).parquet(out + "/exported").select("_index", "_id", "digest")
    actions = {r["action"]: r["n"] for r in changed_documents(done.withColumn("_source", F.lit(None).cast("string")), before)
               .groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows at most
    folders = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(out + "/requests")
    return {"requests": folders.select("path").count() if actions else 0,
            "documents": actions.get("index", 0), "deletions": actions.get("delete", 0)}
