"""Named queries: ``(spark, sf_dir) -> DataFrame``, one per operator group of the
survey's §7.4 table. Every query reads the driver's tables (or data Spark derives and
writes from them) over their whole extent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens import sinks as SK
from pricelens.operators import bucketed as BK
from pricelens.operators import export as EX
from pricelens.operators import formatting as FMT
from pricelens.operators import market as MKT
from pricelens.operators import valuation as VAL
from pricelens.plans import daily as P
from pricelens.session import scratch_path
from pricelens.sources import fixtures as FX
from pricelens.sources import readers as R
from pricelens.sources import sdmx as SD

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the scoped-run examples.
SCOPE_YEARS = [1996, 1997, 1998]
SCOPE_DEPARTMENTS = ["1", "3"]
EARLIER_RUN_DATE = "1998-12-31"
EARLIER_RUN_LAST_YEAR = 1998
LAST_N_RATES = 30
BROKEN_DEPARTMENT = "2"
OPEN_WRITERS = 128


# ── sales ───────────────────────────────────────────────────────────────────────

def sales_parse(spark, sf_dir):
    return FMT.parse_sales(FX.raw_sales(spark, sf_dir))


def sales_filtered(spark, sf_dir):
    return FMT.sales_reject_reason(FX.raw_sales(spark, sf_dir)).filter(
        F.col("reject_reason") == FMT.REJECT_OK).drop("reject_reason")


def sales_formatted(spark, sf_dir):
    return P.formatted_sales(spark, sf_dir)


def sales_reject_reasons(spark, sf_dir):
    return (FMT.sales_reject_reason(FX.raw_sales(spark, sf_dir))
            .groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows")))


def sales_by_year(spark, sf_dir):
    return (P.formatted_sales(spark, sf_dir).groupBy("year")
            .agg(F.count(F.lit(1)).alias("n_sales")))


def sales_scoped(spark, sf_dir):
    return FMT.scope_sales(P.formatted_sales(spark, sf_dir), SCOPE_YEARS, SCOPE_DEPARTMENTS)


def rooms_bucket_counts(spark, sf_dir):
    return (P.formatted_sales(spark, sf_dir).groupBy("rooms_bucket")
            .agg(F.count(F.lit(1)).alias("n_sales")))


def sales_union_years(spark, sf_dir):
    """SRC-4 + SET-1 + SRC-12: land pipe-delimited files by sale year in one folder -- the
    earlier years with one column order, the later ones reversed, each with a column
    outside the whitelist -- then read every file by its own header and union by name.
    Every row is landed and read back."""
    raw = FX.raw_sales(spark, sf_dir).withColumn(
        "_year", F.substring("date_mutation", 1, 4)).withColumn("id_parcelle", F.lit("x"))
    root = scratch_path(spark, "dvf-years")
    cols = list(C.RAW_SALES_COLUMNS)
    early = F.coalesce(F.col("_year") <= str(EARLIER_RUN_LAST_YEAR), F.lit(False))
    (raw.select(*cols, "id_parcelle", "_year").filter(early)
     .write.partitionBy("_year").option("header", True).option("sep", "|").csv(root + "/all"))
    (raw.select("id_parcelle", *cols[::-1], "_year").filter(~early)
     .write.partitionBy("_year").option("header", True).option("sep", "|").mode("append").csv(root + "/all"))
    paths = [root + "/all", root + "/missing-department"]
    union = R.read_whitelisted_csv(spark, paths, sep="|")
    return FMT.parse_sales(union)


def sales_quarantine(spark, sf_dir):
    """SRC-12: a pipe-delimited file for each department, one of them broken (lines with a surplus field). It is left
    out whole, the others land; every row carries the number of broken lines, which are in the rejects."""
    from pricelens.plans import landing as L
    root = scratch_path(spark, "dvf-broken")
    raw, cols = FX.raw_sales(spark, sf_dir), list(C.RAW_SALES_COLUMNS)
    broken = (F.col("code_departement") == BROKEN_DEPARTMENT) & (F.col("valeur_fonciere") == "")
    line = F.concat(F.array_join(F.array(*cols), "|", ""), F.when(broken, "|surplus").otherwise(""))
    # A department's file is written as its rows come; without open writers its task would sort all of them first.
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(OPEN_WRITERS))
    try:
        (raw.select(line.alias("|".join(cols)), F.col("code_departement").alias("department")).repartition("department")
         .write.partitionBy("department").option("header", True).option("sep", "\x01").option("quote", "").csv(root + "/files"))
    finally:
        spark.conf.set(setting, before)
    L.land_sales(spark, [root + "/files", root + "/missing-department"], root + "/raw", P.INGESTION_DATE)
    lines = spark.read.schema("file string, line long, reason string").json(root + "/raw/rejects/dvf").agg(F.count("reason")).scalar()
    return FMT.parse_sales(R.read_landed_csv(spark, root + "/raw/dvf")).withColumn("n_broken_lines", lines)


# ── rents ───────────────────────────────────────────────────────────────────────

def rents_merged(spark, sf_dir):
    return FX.raw_rents(spark, sf_dir)


def rents_formatted(spark, sf_dir):
    return P.formatted_rents(spark, sf_dir)


def rents_latest(spark, sf_dir):
    return MKT.latest_rents(P.formatted_rents(spark, sf_dir))


def delimiter_detect(spark, sf_dir):
    """SRC-5: land the rent table with ``;`` (values keep their decimal commas), sniff the delimiter and read
    the rows back with it, all from one scan of the text."""
    path = scratch_path(spark, "rents-landed")
    SK.land_csv(FX.raw_rents(spark, sf_dir), path, P.INGESTION_DATE, sep=";")
    lines = R.landed_lines(spark, path)
    sep = R.detect_delimiter(spark, path, lines)
    n_rows = R.read_csv_detected(spark, path, lines=lines).agg(F.count(F.lit(1)).alias("n_rows"))
    fields = lines.agg(F.max(F.size(F.split("value", sep, -1))).alias("fields_per_line"))
    stats = R.delimiter_counts(lines).agg(F.sum("n_comma").alias("n_comma"))
    return (stats.select(F.lit(sep).alias("delimiter"), "n_comma")
            .withColumns({"n_rows": n_rows.scalar(), "fields_per_line": fields.scalar()}))


# ── rates ───────────────────────────────────────────────────────────────────────

def rates_formatted(spark, sf_dir):
    return P.formatted_rates(spark, sf_dir).select(*C.RATES.fieldNames())


def rates_latest_per_type(spark, sf_dir):
    return FMT.latest_rates_per_type(P.formatted_rates(spark, sf_dir))


def rates_last_n(spark, sf_dir):
    return FMT.last_n_rates(P.formatted_rates(spark, sf_dir), LAST_N_RATES)


def rate_latest(spark, sf_dir):
    return MKT.latest_rate(FMT.latest_rates_per_type(P.formatted_rates(spark, sf_dir)))


def rates_fallback(spark, sf_dir):
    return R.with_fallback_row(FX.raw_rates(spark, sf_dir), P.INGESTION_DATE, R.FALLBACK_RATE,
                               R.FALLBACK_RATE_TYPE, R.FALLBACK_SOURCE)


def rates_fallback_empty(spark, sf_dir):
    """SRC-10 + PRJ-25 with nothing to read: no event has this type, so the row stands in."""
    none = FX.raw_rates(spark, sf_dir).filter(F.col("rate_type") == "no such type")
    return R.with_fallback_row(none, P.INGESTION_DATE, R.FALLBACK_RATE, R.FALLBACK_RATE_TYPE, R.FALLBACK_SOURCE)


#: Records in a landed JSON array.
ARRAY_BLOCK = 8192


def _rate_arrays(raw):
    """Raw rates as indented JSON arrays: (value, rate_type, block), one array a row."""
    record = F.struct("event_id", F.to_json(F.struct(*C.RAW_RATES.fieldNames()), {"pretty": "true"}).alias("r"))
    return raw.groupBy("rate_type", F.floor(F.col("event_id") / ARRAY_BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(record)).alias("records")).select(
        F.concat(F.lit("[\n"), F.array_join("records.r", ",\n"), F.lit("\n]")).alias("value"), "rate_type", "block")


def rates_json_array(spark, sf_dir):
    """SRC-2 in the reference's form: rates landed as indented JSON arrays, one for each
    type and block of events, read back without being told so."""
    path = scratch_path(spark, "rates-arrays")
    # One array a file.
    _rate_arrays(FX.raw_rates(spark, sf_dir)).drop("rate_type", "block").write.option("maxRecordsPerFile", 1).text(path)
    back = R.read_json_records(spark, path, C.RAW_RATES)
    return FMT.format_rates(back, P.INGESTION_DATE)


def rates_json_mixed(spark, sf_dir):
    """SRC-2 over a landing of both forms: one day records as lines, some of them cut off and unreadable, the
    next day indented arrays. Every readable record comes back, with the number of unreadable ones."""
    path = scratch_path(spark, "rates-mixed")
    raw = FX.raw_rates(spark, sf_dir)
    line = F.to_json(F.struct(*C.RAW_RATES.fieldNames()))
    cut = F.when(F.col("event_id") % 98 == 0, F.substring(line, 1, 20)).otherwise(line)
    raw.where("event_id % 2 = 0").select(cut.alias("value")).write.text(f"{path}/ingestion_date=2024-12-30")
    _rate_arrays(raw.where("event_id % 2 <> 0")).drop("rate_type", "block").write.option("maxRecordsPerFile", 1).text(
        f"{path}/ingestion_date={P.INGESTION_DATE}")
    back = R.read_json_records(spark, path, C.RAW_RATES, corrupt="unreadable")
    lost = R.count_unreadable(back, "unreadable").scalar()
    return FMT.format_rates(back.where(F.col("unreadable").isNull()).drop("unreadable"), P.INGESTION_DATE).withColumn(
        "n_unreadable", lost)


def rates_sdmx(spark, sf_dir):
    docs = SD.pack_sdmx(FX.raw_rates_detailed(spark, sf_dir))
    return R.parse_sdmx(docs)


def rates_json_roundtrip(spark, sf_dir):
    """SNK-4 + SRC-2: land raw rates as JSON records, read back with the fixed schema."""
    path = scratch_path(spark, "rates-landed")
    SK.land_json(FX.raw_rates(spark, sf_dir).select(*C.RAW_RATES.fieldNames()), path, P.INGESTION_DATE)
    back = R.read_json_records(spark, path, C.RAW_RATES, multiline=False)
    return FMT.format_rates(back, P.INGESTION_DATE)


# ── segments / estimates ────────────────────────────────────────────────────────

def segment_stats(spark, sf_dir):
    return MKT.segment_stats(P.formatted_sales(spark, sf_dir))


def segment_stats_approx(spark, sf_dir):
    return MKT.segment_stats(P.formatted_sales(spark, sf_dir), method="approx")


def segment_stats_merged(spark, sf_dir):
    """Segment statistics from two states merged: one over sales up to 1998 (the stored
    history) and one over the later sales (the new landing)."""
    sales = P.formatted_sales(spark, sf_dir)
    old = F.col("year") <= EARLIER_RUN_LAST_YEAR
    both = MKT.segment_histogram(sales.withColumn("_old", F.coalesce(old, F.lit(False))), ["_old"])  # one pass
    return MKT.stats_from_histogram(MKT.merge_histograms(both.filter("_old"), both.filter("not _old")))


def segment_stats_exact(spark, sf_dir):
    return MKT.segment_stats(P.formatted_sales(spark, sf_dir), exact=True)


def segment_stats_sketch(spark, sf_dir):
    return MKT.segment_stats(P.formatted_sales(spark, sf_dir), method="sketch")


def segment_stats_hot(spark, sf_dir):
    """All sales in one segment (more than any sketch holds exactly): quantiles stay exact."""
    hot = P.formatted_sales(spark, sf_dir)
    for k in MKT.KEYS:
        hot = hot.withColumn(k, F.lit("all"))
    return MKT.segment_stats(hot)


def segment_rent(spark, sf_dir):
    return MKT.attach_rent(MKT.segment_stats(P.formatted_sales(spark, sf_dir)), P.formatted_rents(spark, sf_dir))


def segment_rate(spark, sf_dir):
    return MKT.attach_rate(MKT.segment_stats(P.formatted_sales(spark, sf_dir)), P.formatted_rates(spark, sf_dir))


def segment_liquidity(spark, sf_dir):
    seg = MKT.segment_counts(P.formatted_sales(spark, sf_dir))
    return seg.select(*MKT.KEYS, "transaction_count",
                      MKT.X.liquidity_score("transaction_count").alias("market_liquidity_score"))


def segment_yield(spark, sf_dir):
    seg = MKT.attach_rent(MKT.segment_stats(P.formatted_sales(spark, sf_dir)), P.formatted_rents(spark, sf_dir))
    return seg.select(*MKT.KEYS, "median_price_m2", "rent_m2",
                      MKT.X.gross_yield("rent_m2", "median_price_m2").alias("estimated_gross_yield"))


def segment_confidence(spark, sf_dir):
    seg = MKT.segment_counts(P.formatted_sales(spark, sf_dir))
    return seg.select(*MKT.KEYS, "transaction_count",
                      MKT.X.confidence("transaction_count").alias("fair_price_confidence"))


def fair_price_estimates(spark, sf_dir):
    return P.estimates(spark, sf_dir)


def estimates_history(spark, sf_dir) -> DataFrame:
    """Two runs in one table: today's over all sales, and an earlier run that only saw
    sales up to its own date (as a dynamic-overwrite table would hold them).

    One pass over the sales: one written histogram split by period, the earlier run read off
    its early part, today's run off the whole."""
    sales = P.formatted_sales(spark, sf_dir).withColumn(
        "_early", F.coalesce(F.col("year") <= EARLIER_RUN_LAST_YEAR, F.lit(False)))
    rents, rates = P.formatted_rents(spark, sf_dir), P.formatted_rates(spark, sf_dir)
    state = MKT.segment_histogram(sales, extra_keys=["_early"])
    now = MKT.estimates_from_segments(MKT.stats_from_histogram(MKT.merge_histograms(state)),
                                      rents, rates, P.COMPUTATION_DATE)
    early_stats = MKT.stats_from_histogram(state.filter(F.col("_early")))
    earlier = MKT.estimates_from_segments(
        early_stats, rents, rates.filter(F.col("rate_date") <= F.lit(EARLIER_RUN_DATE).cast("date")),
        EARLIER_RUN_DATE)
    return now.unionByName(earlier)


def estimates_latest(spark, sf_dir):
    return VAL.latest_estimates(estimates_history(spark, sf_dir))


def estimates_roundtrip(spark, sf_dir):
    """SNK-1 (+ SNK-2 guard) then SRC-3/SRC-11: write the usage table partitioned by
    computation date, read it back through the estimates source."""
    path = scratch_path(spark, "usage-estimates")
    SK.write_parquet(P.estimates(spark, sf_dir), path, partition_by=["computation_date"], stage="estimates")
    return R.read_estimates(spark, path)


def estimates_json_snapshot(spark, sf_dir):
    """SRC-11's second choice: the estimates as a JSON array for each commune, read with
    the contract where there is no Parquet."""
    path = scratch_path(spark, "estimates-json")
    est = P.estimates(spark, sf_dir)
    record = F.to_json(F.struct(*est.columns), {"dateFormat": "yyyy-MM-dd"})
    arrays = est.groupBy(F.col("commune_code").alias("file")).agg(F.collect_list(record).alias("r")).select(
        F.concat(F.lit("[\n"), F.array_join("r", ",\n"), F.lit("\n]")).alias("value"), "file")
    arrays.write.partitionBy("file").text(path)
    return R.read_estimates(spark, path + "-parquet", path).select(*C.ESTIMATE_COLUMNS)


def landing_roundtrip(spark, sf_dir):
    """SNK-3 then SRC-1 + SRC-9: land raw sales as CSV in an ingestion-date folder,
    read the folder back as text, guard emptiness, and format it."""
    path = scratch_path(spark, "dvf-landed")
    SK.land_csv(FX.raw_sales(spark, sf_dir), path, P.INGESTION_DATE)
    raw = R.read_landed_csv(spark, path, snapshot="latest")
    if not R.has_rows(raw):
        return spark.createDataFrame([], C.SALES)
    return FMT.format_sales(raw)


def sales_incremental(spark, sf_dir):
    """Two landings (sales shipped before 1998, then the rest, as two ingestion dates),
    each followed by an ``availableNow`` streaming run; the table then holds every
    sale exactly once, although the second run could see both landings."""
    from pricelens.streaming.ingest import format_landed_sales
    root = scratch_path(spark, "incremental")
    landed, table, ckpt = root + "/landed", root + "/sales", root + "/checkpoint"
    raw = FX.raw_sales(spark, sf_dir)
    early = F.coalesce(F.substring("date_mutation", 1, 4) < "1998", F.lit(False))
    SK.land_csv(raw.filter(early), landed, "2024-12-30")
    format_landed_sales(spark, landed, table, ckpt)
    SK.land_csv(raw.filter(~early), landed, "2024-12-31")
    format_landed_sales(spark, landed, table, ckpt)
    return spark.read.parquet(table).select(*C.SALES.fieldNames())


def _publish_sources(spark, sf_dir, root):
    """The sources as they are published, under ``root``: pipe-delimited sales files, the two rent files,
    and the rate service's SDMX-JSON documents by rate type (the last observation of each day).
    Returns the rate documents' paths by rate type."""
    FX.raw_sales(spark, sf_dir).write.option("header", True).option("sep", "|").csv(root + "/sales")
    for side, name in zip(FX.rent_sources(spark, sf_dir), ("apartments", "houses"), strict=True):
        side.write.option("header", True).option("sep", ";").csv(f"{root}/{name}")
    daily = FX.raw_rates(spark, sf_dir).where("rate_value is not null").groupBy(
        "rate_type", "source", F.col("date").alias("period")).agg(
        F.max_by("rate_value", F.struct("ts", "event_id")).alias("rate_value"), F.max("event_id").alias("event_id"))
    docs = SD.pack_sdmx(daily).select("rate_type", F.col("json").alias("value"))
    docs.write.partitionBy("rate_type").option("maxRecordsPerFile", 1).text(root + "/rates")  # one document a file
    types = docs.select("rate_type").distinct().collect()  # a handful of rate series
    return {r["rate_type"]: f"{root}/rates/rate_type={r['rate_type']}" for r in types}


def _land_published(spark, sf_dir, root):
    """Publish the sources and run every landing job; returns the raw root."""
    from pricelens.plans import landing as L
    published, raw_root = root + "/published", root + "/raw"
    rate_paths = _publish_sources(spark, sf_dir, published)
    L.land_sales(spark, [published + "/sales"], raw_root, P.INGESTION_DATE)
    L.land_rents(spark, published + "/apartments", published + "/houses", raw_root, P.INGESTION_DATE)
    L.land_rates(spark, rate_paths, raw_root, P.INGESTION_DATE)
    return raw_root


def daily_run(spark, sf_dir):
    """The daily run end to end over files: land published sales files (pipe-delimited), the
    two rent files and the rate service's documents through the landing jobs, format each into
    the formatted layer, compute and write the usage table, read it back."""
    root = scratch_path(spark, "lake")
    raw_root = _land_published(spark, sf_dir, root)
    P.run_daily(spark, raw_root, root + "/lake", P.COMPUTATION_DATE, P.INGESTION_DATE)
    return R.read_estimates(spark, root + "/lake/usage/fair_price_estimates")


def sales_deduplicated(spark, sf_dir):
    """Q-5: the same raw sales landed on two ingestion dates, read together, formatted
    with ``dedup=True`` -- every distinct formatted sale once."""
    path = scratch_path(spark, "dvf-replayed")
    raw = FX.raw_sales(spark, sf_dir)
    SK.land_csv(raw, path, "2024-12-30")
    SK.land_csv(raw, path, P.INGESTION_DATE)
    return FMT.format_sales(R.read_landed_csv(spark, path), dedup=True)


def daily_incremental(spark, sf_dir):
    """Two days of the incremental run: day one lands the sales shipped up to 1998, day
    two the rest; each run formats only its own landing and merges segment state. The
    second day's usage table equals a full recomputation over all sales."""
    from pyspark.sql import types as T
    root = scratch_path(spark, "lake-incremental")
    raw_root, lake = root + "/raw", root + "/lake"
    raw = FX.raw_sales(spark, sf_dir)
    early = F.coalesce(F.substring("date_mutation", 1, 4) <= str(EARLIER_RUN_LAST_YEAR), F.lit(False))
    schema = T.StructType(C.RAW_RATES.fields + [T.StructField("ts", T.TimestampNTZType()),
                                                T.StructField("event_id", T.LongType())])
    SK.land_csv(FX.raw_rents(spark, sf_dir), raw_root + "/rents", P.INGESTION_DATE, sep=";")
    SK.land_json(FX.raw_rates(spark, sf_dir), raw_root + "/rates", P.INGESTION_DATE)
    SK.land_csv(raw.filter(early), raw_root + "/dvf", "2024-12-30")
    P.run_daily_incremental(spark, raw_root, lake, "2024-12-30", "2024-12-30", rates_schema=schema)
    SK.land_csv(raw.filter(~early), raw_root + "/dvf", P.INGESTION_DATE)
    P.run_daily_incremental(spark, raw_root, lake, P.COMPUTATION_DATE, P.INGESTION_DATE, rates_schema=schema)
    usage = R.read_estimates(spark, lake + "/usage/fair_price_estimates")
    return usage.filter(F.col("computation_date") == F.lit(P.COMPUTATION_DATE).cast("date"))


def _incremental(spark, sf_dir, name, first, second, first_rents, second_rents, again=None):
    """Two incremental runs; (rows, landing date) of the sales and rents landed before each, ``again``
    of sales landed over an earlier date between them."""
    from pyspark.sql import types as T
    root = scratch_path(spark, name)
    raw_root, lake = root + "/raw", root + "/lake"
    schema = T.StructType(C.RAW_RATES.fields + [T.StructField("ts", T.TimestampNTZType()),
                                                T.StructField("event_id", T.LongType())])
    SK.land_json(FX.raw_rates(spark, sf_dir), raw_root + "/rates", "2024-12-29")
    for (sales, landed), (rents, edition), run in ((first, first_rents, "2024-12-30"),
                                                   (second, second_rents, P.COMPUTATION_DATE)):
        if again is not None and run == P.COMPUTATION_DATE:
            SK.land_csv(again[0], raw_root + "/dvf", again[1])
        SK.land_csv(sales, raw_root + "/dvf", landed)
        SK.land_csv(rents, raw_root + "/rents", edition, sep=";")
        P.run_daily_incremental(spark, raw_root, lake, run, run, rates_schema=schema)
    usage = R.read_estimates(spark, lake + "/usage/fair_price_estimates")
    return usage.filter(F.col("computation_date") == F.lit(P.COMPUTATION_DATE).cast("date"))


def daily_incremental_late(spark, sf_dir):
    """A landing that arrives late: after the first run, whose state is dated 12-30, more
    sales land under an older date. They are folded in."""
    raw = FX.raw_sales(spark, sf_dir)
    early = F.coalesce(F.substring("date_mutation", 1, 4) <= str(EARLIER_RUN_LAST_YEAR), F.lit(False))
    rents = FX.raw_rents(spark, sf_dir)
    half = F.pmod(F.crc32("code_commune"), F.lit(2)) == 0
    return _incremental(spark, sf_dir, "lake-late", (raw.filter(early), "2024-12-30"), (raw.filter(~early), "2024-12-28"),
                        (rents.filter(half), "2024-12-30"), (rents.filter(~half), "2024-12-31"))


def daily_incremental_rents(spark, sf_dir):
    """Rent editions spread over landings: communes that only the older landing holds keep
    their rents."""
    raw = FX.raw_sales(spark, sf_dir)
    early = F.coalesce(F.substring("date_mutation", 1, 4) <= str(EARLIER_RUN_LAST_YEAR), F.lit(False))
    rents = FX.raw_rents(spark, sf_dir)
    half = F.col("code_commune") < "01012"
    return _incremental(spark, sf_dir, "lake-rents", (raw.filter(early), "2024-12-30"), (raw.filter(~early), "2024-12-31"),
                        (rents.filter(half), "2024-12-29"), (rents.filter(~half), "2024-12-31"))


def daily_incremental_relanded(spark, sf_dir):
    """A date landed again: the first landing of 12-30 holds wrong prices and sales that don't belong to
    it; after the first run it is replaced, and more sales land. What the replaced files had
    left in the state is withdrawn."""
    raw = FX.raw_sales(spark, sf_dir)
    early = F.coalesce(F.substring("date_mutation", 1, 4) <= str(EARLIER_RUN_LAST_YEAR), F.lit(False))
    wrong = raw.filter(early | (F.col("code_commune") < "01004")).withColumn(
        "valeur_fonciere", F.concat(F.lit("1"), "valeur_fonciere"))
    rents = FX.raw_rents(spark, sf_dir)
    return _incremental(spark, sf_dir, "lake-relanded", (wrong, "2024-12-30"), (raw.filter(~early), P.INGESTION_DATE),
                        (rents, "2024-12-30"), (rents.limit(0), P.INGESTION_DATE), again=(raw.filter(early), "2024-12-30"))


def segment_stats_compacted(spark, sf_dir):
    """Segment statistics from a log of three runs, the first two folded into a base: the second
    withdraws the first one's file and brings its sales anew."""
    from pricelens.operators import segment_log as LOG
    root = scratch_path(spark, "segment-log")
    sales = P.formatted_sales(spark, sf_dir)
    old = sales["year"] <= EARLIER_RUN_LAST_YEAR
    rows = lambda df, file: MKT.histogram_rows(df).withColumn("_file", F.lit(file).cast("long"))
    files = lambda *signed: spark.createDataFrame(signed, "file long, sign int")
    LOG.append(spark, root, "1", rows(sales.withColumn("price_per_m2", F.col("price_per_m2") * 2), 1), files((1, 1)))
    gone = files((1, -1)).select("file")
    LOG.append(spark, root, "2", LOG.state(spark, root).withdrawn(gone).unionByName(rows(sales.filter(old), 2)),
               files((1, -1), (2, 1)))
    LOG.compact(spark, root)
    LOG.append(spark, root, "3", rows(sales.filter(~old), 3), files((3, 1)))
    return LOG.state(spark, root).stats()


def segment_stats_streamed(spark, sf_dir):
    """Segment statistics kept by a file stream: two landings, each followed by an
    ``availableNow`` run that merges the new files' histogram into the stored state."""
    from pricelens.streaming.ingest import segment_stats_from_state, update_segment_state
    root = scratch_path(spark, "segment-state")
    landed, state, ckpt = root + "/landed", root + "/state", root + "/checkpoint"
    raw = FX.raw_sales(spark, sf_dir)
    early = F.coalesce(F.substring("date_mutation", 1, 4) <= str(EARLIER_RUN_LAST_YEAR), F.lit(False))
    SK.land_csv(raw.filter(early), landed, "2024-12-30")
    update_segment_state(spark, landed, state, ckpt)
    SK.land_csv(raw.filter(~early), landed, P.INGESTION_DATE)
    update_segment_state(spark, landed, state, ckpt)
    return segment_stats_from_state(spark, state)


def contract_violations(spark, sf_dir):
    """DQ-1 + DQ-2 on estimates that were tampered with: two columns are gone, one has
    another type, and small segments bear a confidence outside the domain, or none."""
    count = F.col("transaction_count")
    est = P.estimates(spark, sf_dir).withColumn("fair_price_confidence", F.when(count % 3 == 0, "HIGHEST").when(
        count % 3 == 1, F.col("fair_price_confidence"))).withColumn("rent_m2", F.col("rent_m2").cast("string")).drop(
        "avg_price_m2", "q75_price_m2")
    missing = len(C.missing_columns(est, C.ESTIMATES))
    mismatched = len(C.type_mismatches(est, C.ESTIMATES))
    return est.agg(F.count_if(C.confidence_violation()).alias("confidence_violations")).select(
        F.lit(missing).alias("missing_columns"), F.lit(mismatched).alias("type_mismatches"),
        "confidence_violations")


def _tampered(est):
    """Estimates of which many break a rule: by count modulo 3 an odd confidence, quartiles in wrong order, no date."""
    kind = F.col("transaction_count") % 3
    return est.withColumns({
        "fair_price_confidence": F.when(kind == 0, "HIGHEST").otherwise(F.col("fair_price_confidence")),
        "q25_price_m2": F.when(kind == 1, F.col("q75_price_m2") + 1).otherwise(F.col("q25_price_m2")),
        "computation_date": F.when(kind != 2, F.col("computation_date"))})


def quality_rules_report(spark, sf_dir):
    """DQ-1…3 as a table of rules in one aggregate over tampered estimates: how many rows break each rule, and
    whether the examples are a bounded set of distinct keys."""
    from pricelens import quality as Q
    found = Q.check(_tampered(P.estimates(spark, sf_dir)), Q.estimate_rules(), MKT.KEYS)
    n = F.size("examples")
    good = (n <= Q.EXAMPLES) & (n >= F.least("n_violations", F.lit(1))) & (F.size(F.array_distinct("examples")) == n)
    return found.select("rule", "n_violations", good.alias("examples_ok"))


def estimates_published(spark, sf_dir):
    """Write, audit, publish: the first version passes; the second breaks rules and is not published, so
    readers still see the first. ``n_rejected`` counts the rule violations that stopped the second."""
    from pricelens import quality as Q
    root = scratch_path(spark, "published-estimates")
    est = MKT.written(P.estimates(spark, sf_dir), "estimates")
    Q.publish(est, root, "1", Q.estimate_rules(), MKT.KEYS)
    n = 0
    try:
        Q.publish(_tampered(est), root, "2", Q.estimate_rules(), MKT.KEYS)
    except Q.AuditFailed as failed:
        n = sum(rows for rows, _ in failed.broken.values())
    return Q.read_published(spark, root).withColumn("n_rejected", F.lit(n).cast("long"))


def daily_ledger(spark, sf_dir):
    """AGG-9: the ledger of a daily run: rows read, rejected by reason, formatted and written, by stage."""
    root = scratch_path(spark, "lake-ledger")
    raw_root = _land_published(spark, sf_dir, root)
    P.run_daily(spark, raw_root, root + "/lake", P.COMPUTATION_DATE, P.INGESTION_DATE)
    return spark.read.parquet(root + "/lake/ledger").select(
        "stage", "n_rows", F.col("computation_date").cast("string").alias("computation_date"))


# ── valuation ───────────────────────────────────────────────────────────────────

def _reference(spark, sf_dir):
    """The estimates as the lookup side of a valuation, written and measured."""
    return VAL.prepared_reference(P.estimates(spark, sf_dir))


def listing_ranges(spark, sf_dir):
    valued = VAL.value_listings(FX.listings(spark, sf_dir), reference=_reference(spark, sf_dir))
    return valued.filter(F.col("status") == VAL.STATUS_OK).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "estimated_fair_price", "low_fair_price", "high_fair_price")


def listing_verdicts(spark, sf_dir):
    return VAL.value_listings(FX.listings(spark, sf_dir), reference=_reference(spark, sf_dir))


def _mixed_listings(spark, sf_dir):
    """The listings, by part number with a NaN, zero, negative or missing surface or price."""
    kind = F.col("l_partkey") % 7
    nan = F.lit(float("nan"))
    return FX.listings(spark, sf_dir).withColumns({
        "surface_m2": F.when(kind == 1, nan).when(kind == 2, 0.0).when(kind == 3, F.lit(None).cast("double"))
        .otherwise(F.col("surface_m2")),
        "asked_price": F.when(kind == 4, nan).when(kind == 5, -F.col("asked_price")).otherwise(F.col("asked_price"))})


def listing_invalid(spark, sf_dir):
    """FLT-11: the listings that are not valued."""
    return VAL.invalid_listings(_mixed_listings(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "commune_code", "property_type", "rooms_bucket")


def listing_verdicts_valid(spark, sf_dir):
    """JOIN-3 over a table of which five sevenths must not be valued."""
    return VAL.value_listings(_mixed_listings(spark, sf_dir), reference=_reference(spark, sf_dir))


def stored_listings(spark, sf_dir, hot_rows=1000, buckets=16):
    """The listings and the estimates as bucketed tables. A third of the listings is put into one segment and some
    are without a type; a segment of over ``hot_rows`` listings is dealt over copies."""
    hot, untyped = F.col("l_partkey") % 3 == 0, F.col("l_partkey") % 11 == 1
    listings = FX.listings(spark, sf_dir).withColumns({
        "commune_code": F.when(hot, "01005").otherwise(F.col("commune_code")),
        "property_type": F.when(hot, "House").when(~untyped, F.col("property_type")),
        "rooms_bucket": F.when(hot, "5+ rooms").otherwise(F.col("rooms_bucket"))})
    root = scratch_path(spark, "stored")
    name = root.rsplit("-", 1)[1]  # of its own for each call
    return (BK.store_listings(listings, f"listings_{name}", root, buckets, hot_rows),
            BK.store_reference(P.estimates(spark, sf_dir), f"reference_{name}", root + "/reference", root, buckets))


def listing_verdicts_stored(spark, sf_dir):
    """JOIN-3 beyond the broadcast limit: both sides bucketed alike, a hot segment in copies."""
    return BK.value_stored(*stored_listings(spark, sf_dir))


def listing_unmatched(spark, sf_dir):
    return VAL.unmatched_listings(FX.listings(spark, sf_dir), reference=_reference(spark, sf_dir))


def verdict_summary(spark, sf_dir):
    return VAL.verdict_summary(listing_verdicts(spark, sf_dir))


def communes(spark, sf_dir):
    return VAL.list_communes(P.estimates(spark, sf_dir))


def commune_count(spark, sf_dir):
    return VAL.commune_count(P.estimates(spark, sf_dir))


def communes_run(spark, sf_dir):
    """The newest run's communes, from a table that holds two runs."""
    return VAL.list_communes(estimates_history(spark, sf_dir))


def market_profile_run(spark, sf_dir):
    """The newest run's profiles, flattened, from a table that holds two runs."""
    return _profile_rows(VAL.market_profiles(estimates_history(spark, sf_dir)))


def documents_run(spark, sf_dir):
    """The newest run's export, parsed back, from a table that holds two runs."""
    return _parsed_documents(SK.documents(estimates_history(spark, sf_dir)))


def documents_earlier_run(spark, sf_dir):
    """An earlier run's export, by its date."""
    return _parsed_documents(SK.documents(estimates_history(spark, sf_dir), computation_date=EARLIER_RUN_DATE))


def market_profile(spark, sf_dir):
    return VAL.market_profiles(P.estimates(spark, sf_dir))


def market_profile_rows(spark, sf_dir, commune_code=None):
    """The profiles flattened: one row per listed segment, with its commune's header
    (name, department, segment count), so the content is checkable row by row."""
    return _profile_rows(VAL.market_profiles(P.estimates(spark, sf_dir), commune_code))


def _profile_rows(prof):
    return prof.select(
        "commune_code", F.col("commune_name").alias("profile_name"),
        F.col("department_code").alias("profile_department"), "segment_count",
        F.posexplode("segments").alias("segment_pos", "s")).select(
        "commune_code", "profile_name", "profile_department", "segment_count", "segment_pos", "s.*")


def market_profile_lookup(spark, sf_dir):
    """FLT-9: one commune's profile -- the commune with the smallest code in the data,
    chosen by a scalar subquery -- flattened."""
    # The smallest code comes from the sales themselves: the estimates are built once.
    code = P.formatted_sales(spark, sf_dir).agg(F.min("commune_code")).scalar()
    return market_profile_rows(spark, sf_dir, commune_code=code)


def documents(spark, sf_dir):
    return SK.documents(P.estimates(spark, sf_dir))


def documents_parsed(spark, sf_dir):
    """The export read back: every document parsed with the estimates contract (dates
    as their ISO text), so the exported content is checked field by field."""
    return _parsed_documents(SK.documents(P.estimates(spark, sf_dir)))


def _changed_documents(spark, sf_dir):
    """What differs between the export of the estimates and one of a day before, which lacks some segments, has other
    medians and one segment more for some, and only another date for the rest."""
    est = MKT.written(P.estimates(spark, sf_dir), "estimates")
    kind = F.col("transaction_count") % 4
    earlier = est.filter(kind != 0).withColumns({
        "median_price_m2": F.when(kind == 1, F.col("median_price_m2") + 1).otherwise(F.col("median_price_m2")),
        "computation_date": F.date_sub("computation_date", 1)})
    gone = earlier.filter(kind == 2).withColumn("rooms_bucket", F.lit("unknown"))
    before = EX.keyed_documents(earlier.unionByName(gone), SK.DEFAULT_INDEX)
    return EX.changed_documents(EX.keyed_documents(est, SK.DEFAULT_INDEX), before)


def documents_changed(spark, sf_dir):
    """SNK-5 for an index that holds an earlier run: new, changed and gone documents only."""
    return _changed_documents(spark, sf_dir).select("_id", "action", "digest")


def documents_requests(spark, sf_dir):
    """The changed documents as bulk requests of at most 5,600 bytes and 6 documents, bodies as digests."""
    requests = EX.bulk_requests(_changed_documents(spark, sf_dir), max_bytes=5600, max_documents=6, digits=1)
    return requests.select("part", "block", "n_documents", "n_bytes", F.sha2("body", 256).alias("body_sha256"))


def _parsed_documents(docs):
    from pyspark.sql import types as T
    schema = T.StructType([f if f.name != "computation_date" else T.StructField(f.name, T.StringType())
                           for f in C.ESTIMATES.fields])
    return docs.select("_index", F.from_json("_source", schema).alias("d")).select("_index", "d.*")


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    sales_parse, sales_filtered, sales_formatted, sales_reject_reasons, sales_by_year,
    sales_union_years, sales_quarantine, sales_scoped, rooms_bucket_counts,
    rents_merged, rents_formatted, rents_latest, delimiter_detect,
    rates_formatted, rates_latest_per_type, rates_last_n, rate_latest, rates_fallback, rates_fallback_empty, rates_json_array, rates_json_mixed,
    rates_sdmx, rates_json_roundtrip,
    segment_stats, segment_stats_approx, segment_stats_merged, segment_stats_exact, segment_stats_sketch, segment_stats_hot, segment_rent, segment_rate, segment_liquidity,
    segment_yield, segment_confidence, fair_price_estimates, estimates_latest,
    estimates_roundtrip, estimates_json_snapshot, landing_roundtrip, sales_incremental, sales_deduplicated, daily_run, daily_incremental, daily_incremental_late, daily_incremental_rents, daily_incremental_relanded, segment_stats_streamed, segment_stats_compacted, contract_violations, quality_rules_report, estimates_published, daily_ledger,
    listing_ranges, listing_verdicts, listing_verdicts_valid, listing_verdicts_stored, listing_invalid, listing_unmatched, verdict_summary,
    communes, communes_run, market_profile_run, documents_run, documents_earlier_run, commune_count, market_profile, market_profile_rows, market_profile_lookup, documents, documents_parsed, documents_changed, documents_requests,
]}
