"""What the operators share: reading tables, whole texts, written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A run of the white space that separates words; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once per application), wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "pricelens_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table, read by Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id`` long and ``text`` string (null: empty) of every row, nothing else.

    With ``carry`` also ``row``, a struct of all columns as they came.
    """
    ship(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []),
    )


def text_key(text: Column | str) -> Column:
    """SHA-256 of a text as it came (null: empty): with the doc_id it names a row up to its other columns."""
    return F.unhex(F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256))


def words(text: Column) -> Column:
    """The words of a text, in order, as an array (empty for an empty text)."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{_local_folder()}"


_LOCAL: list[str] = []


def _local_folder() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="pricelens-llm-"))
    return _LOCAL[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    several uses of the table compute it once.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
