"""Scans: landed CSV / JSON / SDMX-JSON / Parquet, plus header handling.

All readers return lazy DataFrames. Where the reference inspected a file in memory
(delimiter sniffing, alias lookup) the decision is made from a one-row aggregate or
from the schema alone, so no file content passes through the driver.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import contracts as C

log = logging.getLogger(__name__)

# Header alias candidates, first match wins.
RENT_FILE_CODE_ALIASES = ["insee_c", "cod_communes", "code_commune", "codecommune", "cod_comm", "codgeo"]
RENT_FILE_NAME_ALIASES = ["libgeo", "lib_communes", "nom_commune", "libelle_commune", "lib_comm"]
RENT_FILE_VALUE_ALIASES = ["loypredm2", "loyer_m2", "loyer_pred_m2", "loy_pred_m2", "loyerm2", "pred_m2"]
RENT_FILE_YEAR_ALIASES = ["source_year", "annee", "year"]
RENT_ALIASES = {
    "commune_code": ["code_commune", "codecommune", "commune_code"],
    "commune_name": ["nom_commune", "libelle_commune", "commune_name"],
    "rent_m2_apartment": ["loyer_m2_appartement", "loyer_appartement_m2", "rent_m2_apartment"],
    "rent_m2_house": ["loyer_m2_maison", "loyer_maison_m2", "rent_m2_house"],
}
SALES_WHITELIST = list(C.RAW_SALES_COLUMNS)
TIME_DIMENSION = "TIME_PERIOD"
FALLBACK_SUFFIX = " (fallback)"
# The rate series used when the rate service returns nothing.
FALLBACK_RATE = 3.9
FALLBACK_RATE_TYPE = "ESTR"
FALLBACK_SOURCE = "ECB Data Portal"


# ── headers ─────────────────────────────────────────────────────────────────────

def normalize_headers(df: DataFrame) -> DataFrame:
    """SRC-7: lower-case and strip every column name."""
    return df.toDF(*[c.lower().strip() for c in df.columns])


def find_column(df: DataFrame, candidates) -> str | None:
    """First candidate present in ``df`` (schema lookup only)."""
    have = set(df.columns)
    return next((c for c in candidates if c in have), None)


def resolve_aliases(df: DataFrame, aliases: dict, required=()) -> DataFrame:
    """SRC-8: rename the first present candidate of each target; a required target
    with no candidate raises, listing the columns that were found."""
    renames = {}
    for target, candidates in aliases.items():
        if target in df.columns:
            continue  # already named: renaming another candidate onto it would duplicate it
        found = find_column(df, candidates)
        if found is None:
            if target in required:
                raise ValueError(f"no column for {target!r} among {candidates}; columns: {df.columns}")
            continue
        if found != target:
            renames[found] = target
    return df.withColumnsRenamed(renames) if renames else df


# ── CSV ─────────────────────────────────────────────────────────────────────────

def read_landed_csv(spark: SparkSession, path: str, sep: str = ",", snapshot: str = "all",
                    schema: T.StructType | None = None, files: list[str] | None = None) -> DataFrame:
    """SRC-1: header on, no inference (all text), every ``ingestion_date=`` folder; every
    file's header is checked against the columns (mismatch -> error, not misreading).

    ``snapshot="latest"`` keeps only the newest ingestion date: a scalar subquery over the
    file listing (no file is read for it) that also prunes the scan to that folder.
    ``files`` reads these files of the landing only.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("sep", sep).option("encoding", "UTF-8").option("basePath", path))
    source = path if files is None else files
    if schema is None:
        # Column names come from one file's header; with them as an explicit schema and
        # enforceSchema off, Spark checks every file's header against it, so a landing
        # with reordered columns fails loudly instead of being read by position.
        first = reader.csv(source if files is None else files[0])
        schema = T.StructType([T.StructField(c, T.StringType()) for c in first.columns
                               if c != "ingestion_date"])
    df = reader.schema(schema).option("enforceSchema", False).csv(source)
    if snapshot == "latest" and "ingestion_date" in df.columns:
        newest = partition_values(spark, path).agg(F.max("ingestion_date")).scalar()
        df = df.filter(F.col("ingestion_date") == newest)
    return df


def partition_values(spark: SparkSession, path: str) -> DataFrame:
    """One row per file under ``path`` with its partition columns, from the file listing
    alone: the ``binaryFile`` source reads no content unless its ``content`` column is
    selected. Questions such as "newest ingestion date" cost a listing, not a scan."""
    return spark.read.format("binaryFile").load(path).drop("content")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other trouble with the storage is raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _file_path() -> Column:
    """The path of a row's file, as readers take it (the metadata column holds a URI)."""
    path = F.col("_metadata.file_path")
    return F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


#: No path is longer: the length of what is left of one.
MAX_PATH = 2**31 - 1


def _plain_path(path) -> Column:
    """A path without its local scheme, which listings and metadata columns write differently."""
    path = F.col(path) if isinstance(path, str) else path
    return F.when(F.startswith(path, F.lit("file:/")), F.concat(F.lit("/"), F.ltrim(F.substring(path, 7, MAX_PATH), F.lit("/")))).otherwise(path)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file under ``path`` from the listing: ``file`` (a number made of path, size and
    modification time: a file that is written anew is another file), path, partition columns."""
    files = partition_values(spark, path)
    return files.select(F.xxhash64(_plain_path("path"), "length", "modificationTime").alias("file"),
                        *[c for c in files.columns if c not in ("length", "modificationTime")])


def with_file(df: DataFrame, name: str = "_file") -> DataFrame:
    """``df``, which reads files, with each row's file as ``landed_files`` numbers it."""
    meta = F.xxhash64(_plain_path(_file_path()), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time"))
    return df.select("*", meta.alias(name))


#: Why a file, or a line of it, is not taken.
BAD_HEADER = "no_whitelisted_column"
BAD_FIELDS = "too_many_fields"
BAD_TEXT = "not_utf8"


def _text_lines(spark: SparkSession, paths, sep: str) -> DataFrame:
    """file, at (block and order in it), value, n_fields of every line of text files; quoted separators don't count.

    The text is read here, once: the lines are written as Parquet and whatever is asked of them reads that."""
    from pricelens.operators.joins import written
    unquoted = F.regexp_replace("value", '"([^"]|"")*"', "")
    return written(_raw_lines(spark, paths).withColumn(
        "n_fields", F.length(unquoted) - F.length(F.translate(unquoted, sep, "")) + 1), "lines")


def _raw_lines(spark: SparkSession, paths) -> DataFrame:
    """file, at, value (without byte order mark and carriage return) of every line of text files."""
    return spark.read.option("encoding", "UTF-8").option("recursiveFileLookup", True).text(paths).select(
        _file_path().alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("at"),
        F.regexp_replace("value", "^\uFEFF|\r$", "").alias("value"))


def _header_names(fields: Column) -> Column:
    """The names in a header line's fields, without their quotes."""
    return F.transform(fields, lambda c: F.regexp_replace(c, '^"|"$', ""))


def file_verdicts(lines: DataFrame, whitelist, sep: str) -> DataFrame:
    """file, header (column names), reason (NULL: the file is good): one aggregate over all lines, and the first
    lines by their places. Numbers alone are gathered from all lines: text among them would have them sorted.

    A file is bad as a whole if its first line names no whitelisted column, a line has more fields than
    that line, or a line is not UTF-8."""
    from pricelens.operators.joins import size_checked_side
    text = lines.where(F.trim("value") != "")
    blocks = text.groupBy("file", F.col("at.block").alias("block")).agg(
        F.min("at.n").alias("n"), F.max("n_fields").alias("widest"), F.max(F.contains("value", F.lit("\uFFFD"))).alias("broken_text"))
    files, _ = size_checked_side(blocks.groupBy(F.col("file").alias("of")).agg(
        F.min(F.struct("block", "n")).alias("head"), F.max("widest").alias("widest"), F.max("broken_text").alias("broken_text")),
        name="file-heads")
    here = (F.col("file") == F.col("of")) & (F.col("at.block") == F.col("head.block")) & (F.col("at.n") == F.col("head.n"))
    per_file = text.join(files, here).select("file", F.struct("value", "n_fields").alias("first"), "widest", "broken_text")
    header = _header_names(F.split("first.value", re.escape(sep), -1))
    known = F.size(F.array_intersect(F.col("header"), F.array(*[F.lit(c) for c in whitelist]))) > 0
    return per_file.withColumn("header", header).select(
        "file", "header", F.col("first.value").alias("header_line"), F.col("first.n_fields").alias("n_header"),
        F.when(~known, BAD_HEADER).when(F.col("widest") > F.col("first.n_fields"), BAD_FIELDS)
        .when(F.col("broken_text"), BAD_TEXT).alias("reason"))


def read_quarantined_csv(spark: SparkSession, paths, whitelist=SALES_WHITELIST, sep: str = "|",
                         tolerant: bool = True, skipped: list | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-4 + SET-1 + SRC-12: (rows, rejects) of delimited files that each have their own header.

    Rows: the whitelisted columns that a good file has, by name (a column missing from a file, and a field
    missing at a line's end, is NULL). Rejects: file, line, reason for every line that made a file bad, and
    line 1 of a file without a whitelisted column; a bad file is left out whole.

    One pass over the text, whose lines are written as Parquet (``_text_lines``), and no list of files on the
    driver but of those left out, which are logged and appended to ``skipped`` with the paths that don't exist.
    Verdicts and headers are an aggregate over the written lines; they meet the lines of good files by
    broadcast behind a size check, and those are parsed. A quoted
    field may hold the separator, not a line break; a line that repeats its file's header is no row.
    Unless ``tolerant``, a missing path or bad file raises; so do files of which none has a
    whitelisted column (a wrong delimiter)."""
    from pricelens.operators.joins import size_checked_side
    skipped = [] if skipped is None else skipped
    found = [p for p in ([paths] if isinstance(paths, str) else list(paths)) if path_exists(spark, p) or skipped.append(p)]
    if skipped and not tolerant:
        raise FileNotFoundError(skipped[0])
    empty = T.StructType([T.StructField(c, T.StringType()) for c in whitelist])
    none = spark.createDataFrame([], "file string, line long, reason string")
    if not found:
        for p in skipped:
            log.warning("skipping %s", p)
        return spark.createDataFrame([], empty), none
    lines = _text_lines(spark, found, sep)
    verdicts, _ = size_checked_side(file_verdicts(lines, whitelist, sep), name="file-verdicts")
    width, n_files, n_bad = verdicts.agg(F.max(F.when(F.col("reason").isNull(), F.size("header"))), F.count(F.lit(1)),
                                         F.count("reason")).first()
    bad = verdicts.where("reason is not null")
    if n_bad:
        for r in bad.select("file", "reason").collect():  # names of files that are left out
            if not tolerant:
                raise ValueError(f"{r['file']}: {r['reason']}")
            skipped.append(r["file"])
    for p in skipped:
        log.warning("skipping %s", p)
    if not width:
        if n_files and not bad.where(F.col("reason") != BAD_HEADER).count():
            raise ValueError(f"no whitelisted column in any of {n_files} files (wrong delimiter?)")
        return spark.createDataFrame([], empty), _rejects(lines, bad) if n_bad else none
    have = verdicts.where("reason is null").select(F.explode("header").alias("c")).where(
        F.col("c").isin(*whitelist)).distinct().collect()
    columns = [c for c in whitelist if c in {r["c"] for r in have}]
    schema = ", ".join(f"c{i} string" for i in range(width))
    fields = F.from_csv("value", schema, {"sep": sep})
    good = verdicts.where("reason is null").select(F.col("file").alias("of"), "header", "header_line")
    rows = lines.join(good, F.col("file") == F.col("of")).where((F.trim("value") != "") & (F.col("value") != F.col("header_line")))
    parsed = rows.select("header", F.array(*[fields[f"c{i}"] for i in range(width)]).alias("v"))
    at = lambda c: F.array_position("header", c)
    out = parsed.select(*[F.when(at(c) > 0, F.try_element_at("v", at(c).cast("int"))).alias(c) for c in columns])
    return out, _rejects(lines, bad) if n_bad else none


def _rejects(lines: DataFrame, bad: DataFrame) -> DataFrame:
    """file, line (from 1), reason of the lines that made files bad."""
    mine = lines.join(bad.select(F.col("file").alias("of"), "reason", "n_header", "header_line"), F.col("file") == F.col("of"))
    blocks = mine.groupBy("file", F.col("at.block").alias("block")).agg(F.min("at.n").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    wrong = (F.when(F.col("reason") == BAD_HEADER, F.col("value") == F.col("header_line"))
             .when(F.col("reason") == BAD_FIELDS, F.col("n_fields") > F.col("n_header"))
             .otherwise(F.contains("value", F.lit("\uFFFD"))))
    hits = mine.where(wrong).select("file", F.col("at.block").alias("block"), F.col("at.n").alias("n"), "reason")
    return hits.join(starts, ["file", "block"]).select(
        "file", (F.col("before") + F.col("n") - F.col("first") + 1).alias("line"), "reason")


def read_whitelisted_csv(spark: SparkSession, paths, whitelist=SALES_WHITELIST, sep: str = "|",
                         tolerant: bool = True, skipped: list | None = None) -> DataFrame:
    """The rows of ``read_quarantined_csv``."""
    return read_quarantined_csv(spark, paths, whitelist, sep, tolerant, skipped)[0]


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, at, value, n_semicolon, n_comma of every line of the text files under ``path``, which are read
    here, once, and written as Parquet. Delimiters, headers and rows are all taken from it."""
    from pricelens.operators.joins import written
    times = lambda c: F.length("value") - F.length(F.translate("value", c, ""))
    return written(_raw_lines(spark, path).withColumns({"n_semicolon": times(";"), "n_comma": times(",")}), "landed-lines")


def delimiter_counts(lines: DataFrame) -> DataFrame:
    """SRC-5 over ``landed_lines``: occurrences of ``;`` and ``,`` per file, and the delimiter a sniffer
    would choose (``;`` only if strictly more frequent). The text itself is not read for it."""
    agg = lines.groupBy("file").agg(F.sum("n_semicolon").alias("n_semicolon"), F.sum("n_comma").alias("n_comma"),
                                    F.count(F.lit(1)).alias("n_lines"))
    return agg.withColumn("delimiter", F.when(F.col("n_semicolon") > F.col("n_comma"), ";").otherwise(","))


def detect_delimiter(spark: SparkSession, path: str, lines: DataFrame | None = None) -> str:
    """The delimiter for a landed text file or folder (one aggregated row is read)."""
    lines = landed_lines(spark, path) if lines is None else lines
    row = lines.agg(F.sum("n_semicolon").alias("s"), F.sum("n_comma").alias("c")).first()
    return ";" if row is not None and (row["s"] or 0) > (row["c"] or 0) else ","


def read_csv_detected(spark: SparkSession, path: str, snapshot: str = "all", lines: DataFrame | None = None) -> DataFrame:
    """SRC-5 per file: the rows of landed files, each by the delimiter and the header of its own text.

    The text is read once (``landed_lines``, or ``lines`` of it). Columns go by their names, in any order and
    letter case; a column that a file lacks, and a field that a line lacks, is NULL. The driver gets one row
    for each different header, not the files. A quoted field may hold the delimiter, not a line break; blank
    lines are no rows. Partition columns are those of the folder's listing."""
    from pricelens.operators.joins import size_checked_side
    lines = landed_lines(spark, path) if lines is None else lines
    heads = lines.where(F.trim("value") != "").groupBy("file").agg(
        F.min("at").alias("head"), F.min_by("value", "at").alias("line"))
    fields = F.when(F.col("delimiter") == ";", F.split("line", ";", -1)).otherwise(F.split("line", ",", -1))
    names = F.transform(_header_names(fields), lambda c, i: F.when(c == "", F.concat(F.lit("_c"), i.cast("string"))).otherwise(c))
    files, _ = size_checked_side(delimiter_counts(lines).join(heads, "file").select(
        F.col("file").alias("of"), "delimiter", "head", names.alias("names"), F.transform(names, F.lower).alias("header")),
        name="file-headers")
    layouts = sorted((tuple(r["names"]) for r in files.select("names").distinct().collect()), key=lambda n: (-len(n), n))
    if not layouts:
        return read_landed_csv(spark, path, snapshot=snapshot)
    columns: dict[str, str] = {}
    for name in (n for layout in layouts for n in layout):
        columns.setdefault(name.lower(), name)
    schema = ", ".join(f"c{i} string" for i in range(len(layouts[0])))
    rows = lines.join(files, F.col("file") == F.col("of")).where((F.trim("value") != "") & (F.col("at") != F.col("head")))
    by = lambda sep: F.from_csv("value", schema, {"sep": sep})
    rows = rows.select("file", "header", F.when(F.col("delimiter") == ";", by(";")).otherwise(by(",")).alias("v"))
    rows = rows.select("file", "header", F.array(*[F.col(f"v.c{i}") for i in range(len(layouts[0]))]).alias("v"))
    found = lambda c: F.array_position("header", F.lit(c))
    listed = [f for f in partition_values(spark, path).schema.fields
              if f.name not in ("path", "modificationTime", "length") and f.name.lower() not in columns]
    out = rows.select(
        *[F.when(found(low) > 0, F.try_element_at("v", found(low).cast("int"))).alias(name) for low, name in columns.items()],
        *[F.nullif(F.regexp_extract("file", f"/{re.escape(f.name)}=([^/]*)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
          .cast(f.dataType).alias(f.name) for f in listed])
    if snapshot == "latest" and "ingestion_date" in out.columns:
        newest = partition_values(spark, path).agg(F.max("ingestion_date")).scalar()
        out = out.filter(F.col("ingestion_date") == newest)
    return out


# ── JSON ────────────────────────────────────────────────────────────────────────

def json_forms(spark: SparkSession, path: str) -> DataFrame:
    """(file, array): whether each JSON file under ``path`` holds an array or one record per line, from
    its first line that has text; files without any are left out."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        _file_path().alias("file"), F.regexp_replace("value", r"^[\s\uFEFF]+", "").alias("v"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    return lines.where("v <> ''").groupBy("file").agg(F.min_by(F.col("v").startswith("["), "at").alias("array"))


def read_json_records(spark: SparkSession, path: str, schema: T.StructType = C.RAW_RATES,
                      multiline: bool | None = None, corrupt: str | None = None) -> DataFrame:
    """SRC-2: flat records of a fixed schema; a field missing from a record reads as NULL.

    Each file is a JSON array (indented or not) or JSON lines; by default its first line with text tells,
    and files of one form are one scan. ``multiline`` says so for all files without a look.
    ``corrupt`` names a column that holds the text of what can't be read as a record (a line; a broken array
    as a whole) and is NULL for records; without it such rows have NULL in every field."""
    if corrupt is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", corrupt or "_corrupt_record")

    def scan(array: bool, files=None) -> DataFrame:
        df = reader.option("multiLine", array)
        return df.json(path) if files is None else df.option("basePath", path).json(files)

    if multiline is not None:
        return scan(multiline)
    forms = json_forms(spark, path)
    kinds = {r["array"] for r in forms.select("array").distinct().collect()}
    if len(kinds) < 2:
        return scan(True in kinds)
    files: dict[bool, list[str]] = {True: [], False: []}
    for r in forms.collect():  # names of files, only where both forms have landed
        files[r["array"]].append(r["file"])
    lines, arrays = scan(False, sorted(files[False])), scan(True, sorted(files[True]))
    return lines.unionByName(arrays, allowMissingColumns=True)


def count_unreadable(records: DataFrame, corrupt: str) -> DataFrame:
    """One row, ``n_unreadable``: how many lines or arrays ``read_json_records(corrupt=...)`` could not read."""
    # Spark refuses to scan for the corrupt column alone, so a field is looked at, whatever it holds.
    field = F.coalesce(F.length(F.col(records.columns[0]).cast("string")) >= 0, F.lit(True))
    return records.agg(F.count_if(F.col(corrupt).isNotNull() & field).alias("n_unreadable"))


SDMX_SCHEMA = T.StructType([T.StructField("data", T.StructType([
    T.StructField("dataSets", T.ArrayType(T.StructType([
        T.StructField("series", T.MapType(T.StringType(), T.StructType([
            T.StructField("observations", T.MapType(T.StringType(), T.ArrayType(T.DoubleType())))])))]))),
    T.StructField("structure", T.StructType([
        T.StructField("dimensions", T.StructType([
            T.StructField("observation", T.ArrayType(T.StructType([
                T.StructField("id", T.StringType()),
                T.StructField("values", T.ArrayType(T.StructType([T.StructField("id", T.StringType())])))])))]))])),
]))])


def parse_sdmx(docs: DataFrame, json_col: str = "json", rate_type: Column | str = "rate_type",
               source: Column | str = "source") -> DataFrame:
    """SRC-6 + FLT-8: SDMX-JSON documents -> (date, rate_value, rate_type, source).

    The TIME_PERIOD dimension gives the period list; every series and every
    observation is exploded; the observation index picks the period. Indices outside
    the list and NULL values are skipped; a malformed document or one without a
    TIME_PERIOD dimension yields no rows.
    """
    rt = F.col(rate_type) if isinstance(rate_type, str) else rate_type
    src = F.col(source) if isinstance(source, str) else source
    d = docs.select(F.from_json(F.col(json_col), SDMX_SCHEMA).alias("doc"),
                    rt.alias("rate_type"), src.alias("source"))
    dims = F.col("doc.data.structure.dimensions.observation")
    time_dim = F.try_element_at(F.filter(dims, lambda x: x["id"] == TIME_DIMENSION), F.lit(1))
    d = d.select(
        F.transform(time_dim["values"], lambda v: v["id"]).alias("periods"),
        F.try_element_at(F.col("doc.data.dataSets"), F.lit(1))["series"].alias("series"),
        "rate_type", "source",
    )
    s = d.select("periods", "rate_type", "source", F.explode("series").alias("series_key", "s"))
    o = s.select("periods", "rate_type", "source",
                 F.explode("s.observations").alias("idx", "vals"))
    idx = F.col("idx").try_cast("int")
    o = o.select(
        F.when((idx >= 0) & (idx < F.size("periods")), F.try_element_at("periods", idx + 1)).alias("date"),
        F.try_element_at("vals", F.lit(1)).alias("rate_value"),
        "rate_type", "source",
    )
    return o.filter(F.col("date").isNotNull() & F.col("rate_value").isNotNull())


# ── Parquet / estimates ─────────────────────────────────────────────────────────

def read_estimates(spark: SparkSession, parquet_path: str | None, json_path: str | None = None) -> DataFrame:
    """SRC-3 + SRC-11: estimates from Parquet (with partition discovery), else from a JSON
    snapshot, array or lines, read with the explicit contract (so ``01001`` stays text),
    else an error. Only a missing path falls through; other trouble is raised."""
    if parquet_path and path_exists(spark, parquet_path):
        return C.select_present(spark.read.parquet(parquet_path), C.ESTIMATE_COLUMNS)
    if json_path and path_exists(spark, json_path):
        return read_json_records(spark, json_path, C.ESTIMATES)
    raise FileNotFoundError("no usage data found; run the pipeline first")


def has_rows(df: DataFrame) -> bool:
    """SRC-9: the empty-input guard (a one-row probe job, no RDD)."""
    return not df.isEmpty()


def with_fallback_row(df: DataFrame, fallback_date, fallback_rate: float, rate_type: str,
                      source: str) -> DataFrame:
    """SRC-10 + PRJ-25: if ``df`` (raw rates) has no rows, one row
    (date, fallback_rate, rate_type, source + " (fallback)"); otherwise ``df`` unchanged.
    Lazy: the fallback row is filtered by a scalar subquery that probes at most one
    row of ``df``, so no join and no driver round trip is needed."""
    spark = df.sparkSession
    one = spark.range(1).select(
        F.lit(fallback_date).cast("string").alias("date"),
        F.lit(float(fallback_rate)).alias("rate_value"),
        F.lit(rate_type).alias("rate_type"),
        F.concat(F.lit(source), F.lit(FALLBACK_SUFFIX)).alias("source"),
    )
    probe = df.limit(1).agg(F.count(F.lit(1))).scalar()
    fallback = one.filter(probe == 0)
    base = df.select("date", "rate_value", "rate_type", "source")
    return base.unionByName(fallback)
