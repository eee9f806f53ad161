"""The four-table model built from parsed rows.

Physical design: an ACCESS entry and its detail are created from the same
parsed line and always come in pairs, so they are stored in one *wide* row
(entry columns + detail columns + ``action_name``). ``log_entry`` and
``log_access_detail`` are projections of that table:

* a random entry id is written once, in the same row as both halves, so a
  retried task can never give the entry and its detail different ids;
* the 1:1 entry/detail join of the queries becomes a filter on one scan
  (no shuffle at any size);
* queries on entry columns read only those columns (Parquet pruning).

Tables built elsewhere (e.g. loaded from staged CSVs) can still be given as
four separate DataFrames; the queries then use a real join.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schema as S
from ..functions.ids import random_id, uuid5
from ..functions.timestamps import day_of

WIDE_EXTRA = ["action_name", "log_date"]


@dataclass
class Rollups:
    """Counts kept beside a store: whole days of a range need no row."""
    days: DataFrame      # log_date, log_type_id, action_type_id, rows
    blocks: DataFrame    # log_date, block_id, actions (rows with an action type)


@dataclass
class Tables:
    log_type: DataFrame
    action_type: DataFrame
    log_entry: DataFrame
    log_access_detail: DataFrame
    wide: DataFrame | None = None          # entry + detail in one row, if stored so
    rollups: Rollups | None = None

    @staticmethod
    def from_wide(log_type: DataFrame, action_type: DataFrame, wide: DataFrame) -> "Tables":
        return Tables(log_type, action_type, entries_of(wide), details_of(wide), wide)

    def entries_in(self, lo=None, hi=None, closed: bool = True, days=None) -> DataFrame:
        """``log_entry`` restricted to ``lo <= ts <= hi`` (``< hi`` when not
        closed). With the wide layout the matching ``log_date`` partitions
        are pruned as well (a superset predicate, the ts bound decides), and
        ``days`` may be a further condition on ``log_date``."""
        src = self.wide if self.wide is not None else self.log_entry
        ts = F.col("log_timestamp")
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (ts >= lit_like(lo, src, "log_timestamp"))
        if hi is not None:
            h = lit_like(hi, src, "log_timestamp")
            cond = cond & ((ts <= h) if closed else (ts < h))
        if "log_date" in src.columns:
            if lo is not None:
                cond = cond & (F.col("log_date") >= F.to_date(lit_like(lo, src, "log_timestamp")))
            if hi is not None:
                cond = cond & (F.col("log_date") <= F.to_date(lit_like(hi, src, "log_timestamp")))
            if days is not None:
                cond = cond & days(F.col("log_date"))
        out = src.filter(cond)
        return entries_of(out) if self.wide is not None else out

    def entries_on_days(self, lo: date | str | None, hi: date | str | None,
                        hi_inclusive: bool) -> DataFrame:
        """``log_entry`` with ``ts::date`` in ``[lo, hi]`` or ``[lo, hi)``."""
        out = self.on_days(self.wide if self.wide is not None else self.log_entry, lo, hi, hi_inclusive)
        return entries_of(out) if self.wide is not None else out

    @staticmethod
    def on_days(src: DataFrame, lo, hi, hi_inclusive: bool) -> DataFrame:
        """Rows of ``src`` on the days of a range, by ``log_date`` where it has one."""
        d = F.col("log_date") if "log_date" in src.columns else day_of(F.col("log_timestamp"))
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (d >= F.lit(lo).cast("date"))
        if hi is not None:
            h = F.lit(hi).cast("date")
            cond = cond & ((d <= h) if hi_inclusive else (d < h))
        return src.filter(cond)


def lit_like(value, df: DataFrame, col: str):
    """Literal of the column's own timestamp type (LTZ or NTZ).

    A naive datetime is wall-clock time of the session zone, as text is; a bare
    ``F.lit`` would read it in the driver's operating-system zone."""
    dtype = df.schema[col].dataType.simpleString()
    if isinstance(value, datetime):
        if value.tzinfo is None:
            return F.lit(value.isoformat(sep=" ")).cast(dtype)
        if dtype == "timestamp_ntz":
            return F.lit(value).cast("timestamp").cast("timestamp_ntz")
    return F.lit(value).cast(dtype)


def entries_of(wide: DataFrame) -> DataFrame:
    """``log_entry`` columns of the wide layout."""
    return wide.select(*S.ENTRY_FIELDS)


def has_detail(wide: DataFrame):
    """Whether a wide row holds a detail: parsed ACCESS rows always do, loaded ones say so."""
    access = F.col("log_type_id") == S.ACCESS
    return access & F.coalesce("has_detail", F.lit(True)) if "has_detail" in wide.columns else access


def details_of(wide: DataFrame) -> DataFrame:
    """``log_access_detail`` rows: at most one per ACCESS entry (K4 by construction)."""
    return (wide.filter(has_detail(wide))
                .select(F.col("id").alias("log_entry_id"), *S.DETAIL_VALUE_FIELDS))


# --- M1 / M2 / A7 / U2 / A8 -------------------------------------------------

def known_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few fixed rows whose size the planner knows, so that joins with them are broadcast.

    Rows of plain ``createDataFrame`` have no size: a join with them shuffles the other side by the
    key, and a dimension of ten names then makes ten tasks of it at most.
    """
    cells = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*cells)))


def log_type_table(spark: SparkSession) -> DataFrame:
    """M1: the fixed three-row dimension, ids in declaration order."""
    return known_rows(spark, [(i, n) for i, n in enumerate(S.LOG_TYPE_NAMES, start=1)], S.LOG_TYPE)


def action_names(rows: DataFrame) -> DataFrame:
    """Distinct action names of parsed rows, sorted."""
    return (rows.select(F.col("action_name").alias("name"))
                .filter(F.col("name").isNotNull()).distinct().orderBy("name"))


def action_type_table(names: DataFrame) -> DataFrame:
    """M2: name -> deterministic id, from a DataFrame with a ``name`` column."""
    return names.select(uuid5(F.col("name")).alias("id"), F.col("name"))


def merge_action_types(*dims: DataFrame) -> DataFrame:
    """Union of action-type tables, one row per name, sorted by name."""
    out = dims[0]
    for d in dims[1:]:
        out = out.unionByName(d)
    return out.dropDuplicates(["name"]).orderBy("name")


def action_id_conflicts(*dims: DataFrame) -> DataFrame:
    """Names that carry more than one id across the given tables."""
    out = dims[0]
    for d in dims[1:]:
        out = out.unionByName(d)
    return (out.groupBy("name").agg(F.count_distinct("id").alias("ids"))
               .filter(F.col("ids") > 1))


def check_action_ids(*dims: DataFrame) -> None:
    """A8 as a hard check: raise when a name has two ids."""
    r = action_id_conflicts(*dims).agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name")).first()
    if r["n"]:
        raise ValueError(f"action type id mismatch for {r['n']} name(s), the first is {r['name']}")


# --- U1 / M3-M6 -------------------------------------------------------------

def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate per-kind frames by column name, duplicates kept."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def to_wide(parsed_rows: DataFrame, id_col=None, extra=()) -> DataFrame:
    """M3-M5: parsed rows -> wide rows (id, entry columns, detail columns,
    action name, log_date). Detail columns are NULL for non-ACCESS rows."""
    is_access = F.col("log_type_id") == S.ACCESS
    return parsed_rows.select(*extra,
        (id_col if id_col is not None else random_id()).alias("id"),
        F.col("log_type_id").cast("short").alias("log_type_id"),
        uuid5(F.col("action_name")).alias("action_type_id"),
        "log_timestamp", "source_ip", "dest_ip", "block_id", "size_bytes",
        *[F.when(is_access, F.col(c)).alias(c) for c in S.DETAIL_VALUE_FIELDS],
        "action_name",
        day_of(F.col("log_timestamp")).alias("log_date"),
    )
