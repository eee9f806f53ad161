"""Raw log files as text DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: default file name of each log kind ------------------------
LOG_FILES = {
    "access": "access_log_full",
    "dataxceiver": "HDFS_DataXceiver.log",
    "namesystem": "HDFS_FS_Namesystem.log",
}
# ---------------------------------------------------------------------------


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """``(value, file)``: one row per line. ``spark.read.text`` splits on
    ``\\n``, ``\\r\\n`` and ``\\r`` and splits large files across tasks."""
    return (spark.read.text(path)
                 .select("value", F.col("_metadata.file_path").alias("file")))


def default_paths(root: str) -> dict:
    """The default file of each log kind below ``root``, as ``ingest`` takes them."""
    return {k: f"{root.rstrip('/')}/{v}" for k, v in LOG_FILES.items()}


def read_folder(spark: SparkSession, root: str) -> DataFrame:
    """``(value, kind)`` of all files below ``root`` in one scan.

    The kind follows from the default file names (a file, or a folder of part files, of that name);
    files of other names are skipped (M7).
    """
    path = F.col("_metadata.file_path")
    kind = F.coalesce(*[F.when(path.rlike(f"/{re.escape(name)}(/[^/]*)?$"), F.lit(k)) for k, name in LOG_FILES.items()])
    lines = spark.read.option("recursiveFileLookup", True).text(root)
    return lines.select("value", kind.alias("kind")).filter(F.col("kind").isNotNull())
