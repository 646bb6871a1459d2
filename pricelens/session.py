"""Session helpers.

The library never builds its own session inside an operator: every function takes
and returns DataFrames and the caller owns the session. ``local_session`` is the
one used by tests, ``bench.py`` and the query registry when run on a laptop.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: AQE re-plans joins from runtime
# sizes (size-checked broadcast, partition coalescing, skew-join splitting), and the
# session time zone is pinned so date/timestamp casts do not depend on the host.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


# Starting points for a large cluster (about 100 TB of input, ~1000 executors). AQE
# coalesces the many shuffle partitions down to ~256 MB each, so the high partition
# count only bounds the largest partition; skew-join splitting handles hot join keys;
# the broadcast threshold stays at a size every executor can hold.
CLUSTER_CONF = {
    **SCALE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


def apply_conf(spark: SparkSession, conf: dict = CLUSTER_CONF) -> SparkSession:
    """Set the runtime SQL settings above on an existing session (static settings such
    as the checkpoint folder come from the cluster and are left alone)."""
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pricelens") -> SparkSession:
    """A local session with the web UI off and the driver bound to loopback."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables and checkpoints.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the cluster (a shared
    file system visible to every executor); without it this raises. Only a local session
    gets a scratch folder of its own, the same one for every call.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        sc.setCheckpointDir(_LOCAL_DIRS[sc.applicationId])
    return _LOCAL_DIRS[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (one per call, never reused)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_SCHEMAS: dict[str, object] = {}


def sf_table(spark: SparkSession, sf_dir: str, name: str):
    """One driver table (``<sf_dir>/<name>.parquet``). The footer schema is read once
    per path and then passed explicitly, so repeated reads skip schema discovery."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)
