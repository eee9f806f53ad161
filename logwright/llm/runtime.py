"""Session helpers shared by the operators: worker import path, written tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path

#: Rows and bytes of an Arrow batch at most.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2048,
         "spark.sql.execution.arrow.maxBytesPerBatch": 32 << 20}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, and this package on the Python workers' import path.

    On a cluster whose machines do not share this folder, ship the package with
    ``--py-files``; the extra path is then without effect.
    """
    configure(spark)
    # Whole texts travel in Arrow batches: few rows and bytes in each.
    for key, most in BATCH.items():
        now = spark.conf.get(key, None)
        if now is None or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written below ``spark.checkpoint.dir`` and read again.

    Cuts lineage so that a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of the bitmap in :func:`likely_members`, as a power of two: 2 MB whatever the data.
BITMAP = 24


def likely_members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may occur in ``ids``; none that does is missing.

    A bitmap of the keys' hashes, at most 2**18 rows of 64 bits, is broadcast: that bound
    does not depend on the data. It keeps most rows without a partner out of the shuffle
    of the exact join that must follow; with very many ids it only filters less.
    """
    place = lambda c: F.xxhash64(c).bitwiseAND((1 << BITMAP) - 1)
    words = (ids.select(place(key).alias("p"))
             .groupBy(F.shiftright("p", 6).alias("_word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                           F.col("p").bitwiseAND(63).cast("int"))).alias("_bits")))
    at = place(key)
    hit = F.call_function("shiftright", F.col("_bits"), at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1
    return (df.join(F.broadcast(words), F.shiftright(at, 6) == F.col("_word")).filter(hit)
            .drop("_word", "_bits"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shield:
    """Rows of a table behind a struct, so that no column name can clash with a step's own.

    ``inner`` has ``row`` (all columns but ``text``), ``text`` and the columns named in
    ``take``; ``restore`` gives the table's columns back, with another text if wanted.
    """

    def __init__(self, docs: DataFrame, *take: str):
        self.schema = docs.schema
        rest = [f.name for f in docs.schema.fields if f.name != "text"]
        self.inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), "text", *take)

    def restore(self, df: DataFrame, text: Column | None = None, changed: Column | None = None) -> DataFrame:
        """``changed``: rows whose text is another one; their ``n_chars``, if there, follows it."""
        text = F.col("text") if text is None else text
        cols = []
        for f in self.schema.fields:
            if f.name == "text":
                cols.append(text.alias("text"))
            elif f.name == "n_chars" and changed is not None:
                cols.append(F.when(changed, F.length(text).cast(f.dataType))
                            .otherwise(F.col("row.n_chars")).alias("n_chars"))
            else:
                cols.append(F.col(f"row.`{f.name}`").alias(f.name))
        return df.select(*cols)
