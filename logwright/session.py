"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The session zone is pinned to UTC because
# day/hour buckets and naive HDFS timestamps are read in the session zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "logwright", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library depends on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is
    read from the session. Only where it is unset (local tests) a fresh
    folder under the system temp directory is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if d and not sc_dir:
        # Named in the conf but not yet applied to the context: apply it, so
        # reliable DataFrame.checkpoint() writes to that shared folder.
        spark.sparkContext.setCheckpointDir(d)
        return d
    if not d:
        d = sc_dir
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="logwright-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - a core conf may be read-only at runtime
            pass
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
