"""Data-quality rules compiled into one aggregate, and versions that are published only after an audit.

``check`` turns a table of rules into one pass over the data: per rule the number of rows that break
it and a bounded set of their keys. ``publish`` writes a version, checks what was written and then
names it in a pointer; readers follow the pointer, so a version that fails is never seen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import contracts as C
from pricelens.sinks import counted, ensure_folder, rows_of
from pricelens.sources.readers import partition_values

#: Keys of offending rows that are reported for a rule, at most.
EXAMPLES = 8


def estimate_rules() -> dict[str, Column]:
    """Rules of the usage table: name -> whether a row breaks it."""
    price = F.col("median_price_m2")
    bad = {
        "confidence_tier": C.confidence_violation(),
        "count_positive": F.col("transaction_count") <= 0,
        "price_positive": ~(price > 0),
        "quartiles_ordered": (F.col("q25_price_m2") > price) | (price > F.col("q75_price_m2")),
        "liquidity_range": ~F.col("market_liquidity_score").between(0, 1),
        "yield_not_negative": F.col("estimated_gross_yield") < 0,
        "commune_code": F.col("commune_code").isNull() | (F.length("commune_code") != 5),
        "computation_date": F.col("computation_date").isNull(),
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in bad.items()}


def check(df: DataFrame, rules: Mapping[str, Column], keys, examples: int = EXAMPLES) -> DataFrame:
    """rule, n_violations, examples: one row per rule from one aggregate over ``df``.

    Examples are keys (JSON) of offending rows, the least of each of ``examples`` hash buckets: a
    bounded set, the same on every run. A rule whose value is NULL is not broken."""
    key = F.to_json(F.struct(*keys))
    bucket = F.pmod(F.xxhash64(key), F.lit(examples))
    aggs = []
    for name, rule in rules.items():
        aggs.append(F.count_if(rule).alias(f"n:{name}"))
        aggs += [F.min(F.when(rule & (bucket == b), key)).alias(f"{b}:{name}") for b in range(examples)]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("rule"), F.col(f"`n:{name}`").alias("n_violations"),
                     F.array_compact(F.array(*[F.col(f"`{b}:{name}`") for b in range(examples)])).alias("examples"))
            for name in rules]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


class AuditFailed(ValueError):
    """A written version breaks rules: ``broken`` is rule -> (rows, some keys)."""

    def __init__(self, version: str, broken: dict[str, tuple[int, list[str]]]):
        super().__init__(f"version {version} was not published: " + ", ".join(f"{k} ({n} rows, e.g. {e[:2]})" for k, (n, e) in broken.items()))
        self.broken = broken


def publish(df: DataFrame, root: str, version: str, rules: Mapping[str, Column], keys) -> int:
    """SNK-1 + SNK-2: write ``df`` as a version, check it, publish it. Returns the rows published.

    The version is a folder of its own (never one that is read), the audit reads what was written: its rules,
    its row count against the count observed while writing, and that it has rows. Publishing is the
    write of one pointer; until then, and after a failed audit (``AuditFailed``), readers see the version
    before. A published version can't be written again."""
    spark = df.sparkSession
    if version in _published(spark, root):
        raise ValueError(f"{root}: version {version} is published")
    out, obs = counted(df, "publish")
    path = f"{root}/versions/version={version}"
    out.write.mode("overwrite").parquet(path)
    n = rows_of(obs)
    back = spark.read.schema(df.schema).parquet(path)
    found = check(back, {**rules, "_any_row": F.lit(True)}, keys).collect()  # a row a rule
    broken = {r["rule"]: (r["n_violations"], list(r["examples"])) for r in found if r["rule"] != "_any_row" and r["n_violations"]}
    rows = next(r["n_violations"] for r in found if r["rule"] == "_any_row")
    if rows != n or not rows:
        broken["row_count"] = (rows, [f"{n} written"])
    if broken:
        raise AuditFailed(version, broken)
    order = len(_published(spark, root))
    spark.range(1).select(F.lit(version).alias("value")).write.text(f"{root}/published/at={order:08d}-{version}")
    return n


def _published(spark: SparkSession, root: str) -> list[str]:
    """Versions in the order of their publication, from a listing."""
    ensure_folder(spark, f"{root}/published")
    names = partition_values(spark, f"{root}/published").select(
        F.regexp_extract("path", r"/at=(\d{8}-[^/]+)/[^/]+$", 1).alias("at")).where("at <> ''").distinct().collect()
    return [n[9:] for n in sorted(r["at"] for r in names)]


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The version published last."""
    versions = _published(spark, root)
    if not versions:
        raise FileNotFoundError(f"{root}: nothing is published")
    return spark.read.parquet(f"{root}/versions/version={versions[-1]}")
