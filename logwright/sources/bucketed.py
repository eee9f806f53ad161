"""Entry and detail as separate tables that are partitioned alike.

Both are written in the same number of buckets by the hash of the entry id, one sorted file
a bucket, so the one-to-one join of Q7 and Q10 needs no exchange: the shuffle is paid once, when
the tables are written, and not by every query. The folder keeps the bucket count;
``open_tables`` gives a new session the same tables.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..operators.model import Tables

#: The bucketed tables and the column that deals out their rows.
KEYS = {"log_entry": "id", "log_access_detail": "log_entry_id"}
BUCKETS = 64


def _table(root: str, name: str) -> str:
    """Name in the session's catalog: one per folder, whatever session or machine asks."""
    return f"lw_{name}_{zlib.crc32(root.encode()):08x}"


def write_tables(t: Tables, root: str, buckets: int = BUCKETS) -> None:
    """Write the four tables below ``root``, entry and detail in ``buckets`` buckets by id.

    A bucket is one task and one file: choose the number so that a bucket of the larger
    table fits a task (about rows x row size / 1 GB).
    """
    spark = t.log_entry.sparkSession
    for name in ("log_type", "action_type"):
        getattr(t, name).select(*[f.name for f in S.ALL_TABLES[name].fields]).write.parquet(f"{root}/{name}")
    for name, key in KEYS.items():
        rows = getattr(t, name).select(*[f.name for f in S.ALL_TABLES[name].fields])
        table = _table(root, name)
        (rows.repartition(buckets, key)  # the same hash as the buckets': one file each
         .write.bucketBy(buckets, key).sortBy(key).option("path", f"{root}/{name}").saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")  # external: the files stay
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{root}/layout")


def _open(spark: SparkSession, root: str, name: str, buckets: int) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{root}/{name}").schema.fields}
    cols = ", ".join(f"{c} {k}" for c, k in kinds.items())
    table, key = _table(root, name), KEYS[name]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {buckets} BUCKETS LOCATION '{root}/{name}'")
    return spark.table(table)


def open_tables(spark: SparkSession, root: str) -> Tables:
    """The tables of ``write_tables``, their layout known to the planner."""
    buckets = spark.read.parquet(f"{root}/layout").first()["buckets"]
    dims = [spark.read.schema(S.ALL_TABLES[n]).parquet(f"{root}/{n}") for n in ("log_type", "action_type")]
    return Tables(*dims, *(_open(spark, root, n, buckets) for n in KEYS))
