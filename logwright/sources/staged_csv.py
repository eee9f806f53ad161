"""Staged CSV form of the four tables.

One folder per table, header and fixed column order, doubled quotes, an empty field
for NULL, timestamps as ISO-8601. Values keep their blanks and backslashes. Rows are
read as text and converted with reasons, so a bad row becomes a reject, not a NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.timestamps import iso_timestamp
from ..operators import model as M

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_OPTIONS = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False}


@dataclass
class Staged:
    tables: M.Tables
    rejects: DataFrame   # table, line, reason


def write_tables(t: M.Tables, folder: str) -> None:
    """The four tables as CSV folders."""
    frames = {"log_type": t.log_type, "action_type": t.action_type,
              "log_entry": t.log_entry, "log_access_detail": t.log_access_detail}
    for name, df in frames.items():
        cols = [f.name for f in S.ALL_TABLES[name].fields]
        (df.select(*cols).write.mode("overwrite").options(**_OPTIONS)
           .option("timestampFormat", ISO_FORMAT).option("emptyValue", "").option("nullValue", "")
           .csv(f"{folder}/{name}"))


def _typed(spark: SparkSession, folder: str, name: str, multiline: bool) -> DataFrame:
    fields = S.ALL_TABLES[name].fields
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields]
                        + [T.StructField("_corrupt", T.StringType())])
    raw = (spark.read.schema(text).options(**_OPTIONS).option("multiLine", multiline)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
           .csv(f"{folder}/{name}"))
    cols, reason = [], F.when(F.col("_corrupt").isNotNull(), F.lit("wrong number of columns"))
    for f in fields:
        c = F.col(f.name)
        value = iso_timestamp(c) if isinstance(f.dataType, T.TimestampType) else \
            c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)
        cols.append(value.alias(f"_v_{f.name}"))
    typed = raw.select("*", *cols)
    for f in fields:
        if not f.nullable:
            reason = reason.when(F.col(f.name).isNull(), F.lit(f"{f.name} is required"))
        reason = reason.when(F.col(f.name).isNotNull() & F.col(f"_v_{f.name}").isNull(),
                             F.lit(f"invalid {f.name}"))
    line = F.coalesce("_corrupt", F.to_csv(F.struct(*[f.name for f in fields])))
    return typed.select(*[F.col(f"_v_{f.name}").alias(f.name) for f in fields],
                        reason.alias("_reason"), line.alias("_line"))


def read_tables(spark: SparkSession, folder: str, multiline: bool = False) -> Staged:
    """S3: staged CSVs as four separate DataFrames (queries then join), and the rejects.

    ``multiline``: values may hold newlines; files are then not split across tasks.
    """
    frames, rejects = {}, []
    for name, schema in S.ALL_TABLES.items():
        typed = _typed(spark, folder, name, multiline)
        frames[name] = typed.filter(F.col("_reason").isNull()).select(*[f.name for f in schema.fields])
        rejects.append(typed.filter(F.col("_reason").isNotNull())
                            .select(F.lit(name).alias("table"), F.col("_line").alias("line"),
                                    F.col("_reason").alias("reason")))
    return Staged(M.Tables(**frames), M.union_all(rejects))
