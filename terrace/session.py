"""Spark session and shared work-folder helpers.

The session defaults are the ones every stage relies on: UTC session time zone and
adaptive query execution with partition coalescing and skew-join splitting.
Partition-replacing writes ask for dynamic overwrite per write, so no global write
setting is changed.

Cluster sizing (shuffle partitions, advisory partition size, file split size) is
left to the cluster's own configuration; ``build_session`` only fills in values that
are not already set, so ``spark-submit --conf`` always wins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when the cluster has not set them already.
DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Checkpoint files are removed once nothing references them (set at start-up).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "terrace",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the engine defaults; explicit ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark, conf)
    return spark


def apply_defaults(spark: SparkSession, conf: dict[str, str] | None = None) -> None:
    """Set the engine's SQL defaults on an existing session (runtime-settable keys only)."""
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        if not key.startswith("spark.sql."):
            continue  # static settings are fixed once the context exists
        if conf and key in conf:
            spark.conf.set(key, value)
        elif spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # The engine always computes dates in UTC, whatever the cluster default is.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def use_local_folder(spark: SparkSession) -> None:
    """On a local master without ``spark.checkpoint.dir``, name a private folder for it.

    For entry points and tests only: operators never choose a folder themselves, as one on
    this machine would not be visible to the executors of a cluster.
    """
    sc = spark.sparkContext
    if _configured_root(spark) is None and (sc.master == "local" or sc.master.startswith("local[")):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="terrace-ckpt-"))


def _configured_root(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    return sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables and streaming checkpoints, as
    ``spark.checkpoint.dir`` names it. Unset, it is an error."""
    root = _configured_root(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder under the shared root: ``<root>/terrace/<parts...>/<uuid>``."""
    base = "/".join([shared_root(spark), "terrace", *parts])
    return f"{base}/{uuid.uuid4().hex}" if unique else base


def materialize(df: DataFrame) -> DataFrame:
    """Cut ``df``'s lineage: write it once to the shared folder and read it back."""
    path = work_dir(df.sparkSession, "materialized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """``materialize`` where a shared folder is named, so that joins know how small ``df`` is; else ``df``."""
    return materialize(df) if _configured_root(df.sparkSession) else df
