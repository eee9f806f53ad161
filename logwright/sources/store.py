"""Parquet store of the model (S5-S9, M6): batches made visible by one commit row.

Layout below a root folder::

    batches/                                     the commit log, append only
    log_type/batch=B/, action_type/batch=B/      dimension rows that batch B was first to bring
    parsed/batch=B/status=ok/log_type_id=N/log_date=D/    wide rows (entry + detail)
    parsed/batch=B/status=rejected/...                    rejected rows with reasons
    days/batch=B/                                rows by day, type, action (and line counts)
    blocks/batch=B/                              actions by day and block

A load writes its rows, then its rollups and new dimension rows, and last one row to
``batches``; readers open the folders of committed batches only. A load that
fails half way therefore shows nothing, and running a batch id again either does
nothing (it was committed) or overwrites what it left. Every line is parsed once:
names, row counts, line counts (P10, P11) and the ``days`` rollup come from one aggregation
over the written rows, so they are exact whatever tasks were retried. A missing store, or a
missing folder of a committed batch, is an error, never an empty table.

``merge_batches`` rewrites the visible batches as one; its commit row replaces those it covers.

The random entry id lives in the same row as both halves of an ACCESS entry, so a
retried task can never give an entry and its detail different ids.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators import model as M
from ..operators import parse as P
from ..operators.reconcile import reconcile
from .logs import read_folder, read_log
from ..functions.ids import random_id

WIDE_SCHEMA = T.StructType(
    [f for f in S.LOG_ENTRY.fields if f.name != "log_type_id"]
    + list(S.LOG_ACCESS_DETAIL.fields[1:])
    + [T.StructField("has_detail", T.BooleanType()), T.StructField("action_name", T.StringType()),
       T.StructField("first_of_line", T.BooleanType()), T.StructField("copies", T.LongType()),
       T.StructField("_line", T.StringType()), T.StructField("reject_reason", T.StringType()),
       T.StructField("kind", T.StringType()), T.StructField("batch", T.StringType()),
       T.StructField("status", T.StringType()), T.StructField("log_type_id", T.ShortType()),
       T.StructField("log_date", T.DateType())])

BATCHES = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("batch", T.StringType()),
    T.StructField("replaces", T.BooleanType()), T.StructField("covers", T.LongType()),
    T.StructField("ok_rows", T.LongType()), T.StructField("rejected_rows", T.LongType()),
    T.StructField("details", T.LongType()), T.StructField("new_names", T.LongType()),
    T.StructField("new_types", T.LongType())])

DAYS = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("log_type_id", T.ShortType()),
    T.StructField("log_date", T.DateType()), T.StructField("action_type_id", T.StringType()),
    T.StructField("action_name", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("details", T.LongType()), T.StructField("total_lines", T.LongType()),
    T.StructField("matched_lines", T.LongType())])

BLOCKS = T.StructType([
    T.StructField("log_date", T.DateType()), T.StructField("block_id", T.LongType()),
    T.StructField("actions", T.LongType())])

KIND_OF_TYPE = {k.log_type_id: name for name, k in P.KINDS.items()}


@dataclass
class IngestResult:
    tables: M.Tables
    rejects: DataFrame
    root: str
    ok_rows: int
    rejected_rows: int


# --- commit log -------------------------------------------------------------------

def _log(spark: SparkSession, root: str) -> list:
    """Commit rows since the last load that replaced everything, oldest first."""
    rows = sorted(spark.read.schema(BATCHES).parquet(f"{root}/batches").collect(), key=lambda r: r["seq"])
    last = max((i for i, r in enumerate(rows) if r["replaces"]), default=0)
    return rows[last:]


def _visible(log: list) -> list:
    merges = [r for r in log if r["covers"] is not None]
    if not merges:
        return log
    # a batch committed while the merge ran has a later number than it covers and stays
    return [merges[-1], *[r for r in log if r["seq"] > merges[-1]["covers"] and r["covers"] is None]]


def committed(spark: SparkSession, root: str) -> list:
    """Visible batches, oldest first (one row per load: bounded by the number of loads)."""
    return _visible(_log(spark, root))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _roll_up(spark: SparkSession, root: str, batch: str) -> None:
    """Write the rollups of a batch from its written rows."""
    rows = spark.read.schema(_without_batch()).parquet(f"{root}/parsed/batch={batch}")
    ok = F.col("status") == "ok"
    line = F.coalesce("first_of_line", F.lit(False))  # NULL: not from log text
    (rows.groupBy("status", "log_type_id", F.when(ok, F.col("log_date")).alias("log_date"),
                  F.when(ok, F.col("action_type_id")).alias("action_type_id"),
                  F.when(ok, F.col("action_name")).alias("action_name"))
     .agg(F.sum(F.coalesce("copies", F.lit(1))).alias("rows"),
          F.count_if(ok & M.has_detail(rows)).alias("details"),
          F.count_if(line).alias("total_lines"),
          F.count_if(line & (ok | (F.col("reject_reason") != P.NO_MATCH))).alias("matched_lines"))
     .write.mode("overwrite").parquet(f"{root}/days/batch={batch}"))
    (rows.filter(ok & F.col("block_id").isNotNull())
     .groupBy("log_date", "block_id").agg(F.count("action_type_id").alias("actions"))
     .write.mode("overwrite").parquet(f"{root}/blocks/batch={batch}"))


def _commit(spark: SparkSession, root: str, wide: DataFrame, mode: str, batch: str | None,
            actions: DataFrame | None = None, types: DataFrame | None = None, covers: int | None = None):
    """Write the wide rows (with status, kind, ...) of a load and make them visible; its commit row.

    ``actions``, ``types``: dimension rows to bring; else the names of the rows and the fixed types.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode}: append or overwrite")
    batch = batch or uuid.uuid4().hex
    log = _log(spark, root) if _exists(spark, f"{root}/batches") else []
    for r in log:
        if r["batch"] == batch:  # replayed: it is in the store already
            return r
    path = f"{root}/parsed/batch={batch}"
    wide.write.mode("overwrite").partitionBy("status", "log_type_id", "log_date").parquet(path)
    _roll_up(spark, root, batch)
    days = spark.read.schema(DAYS).parquet(f"{root}/days/batch={batch}")
    n = days.agg(*[F.coalesce(F.sum(v), F.lit(0)) for v in (
        F.when(F.col("status") == "ok", F.col("rows")), F.when(F.col("status") != "ok", F.col("rows")),
        F.col("details"))]).first()
    if actions is None:
        actions = days.filter("status = 'ok' AND action_name IS NOT NULL").select(
            F.col("action_type_id").alias("id"), F.col("action_name").alias("name")).distinct()
    if types is None:
        types = M.log_type_table(spark)
    if mode == "append" and covers is None and log:
        have = _read_actions(spark, root, _visible(log))
        M.check_action_ids(have, actions)
        actions = actions.join(have.select("name"), "name", "left_anti").select("id", "name")
        types = types.join(_read_types(spark, root, _visible(log)).select("id"), "id", "left_anti").select("id", "name")
    else:
        M.check_action_ids(actions)
    new = []
    for name, rows, schema in (("action_type", actions, S.ACTION_TYPE), ("log_type", types, S.LOG_TYPE)):
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
        new.append(spark.read.schema(schema).parquet(f"{root}/{name}/batch={batch}").count())
    seq = max([time.time_ns(), *(r["seq"] + 1 for r in log)])
    row = (seq, batch, mode == "overwrite", covers, *n, *new)
    commit = spark.createDataFrame([row], BATCHES)
    commit.coalesce(1).write.mode("append").parquet(f"{root}/batches")
    return T.Row(*BATCHES.names)(*row)


def _without_batch() -> T.StructType:
    return T.StructType([f for f in WIDE_SCHEMA.fields if f.name != "batch"])


# --- loads ------------------------------------------------------------------------

def _typed_all(spark: SparkSession, inputs, validate_ips: bool) -> DataFrame | None:
    """Typed rows of the known kinds, parsed in one pass; other kinds are skipped (M7)."""
    if isinstance(inputs, str):
        return P.parse_routed(read_folder(spark, inputs), validate_ips=validate_ips)
    if isinstance(inputs, DataFrame):
        return P.parse_routed(inputs.filter(F.col("kind").isin(*P.KINDS)).select("value", "kind"),
                              validate_ips=validate_ips)
    frames = []
    for kind, src in inputs.items():
        if kind not in P.KINDS:
            continue
        lines = read_log(spark, src) if isinstance(src, str) else src
        col = "value" if "value" in lines.columns else "line"
        frames.append(lines.select(F.col(col).alias("value"), F.lit(kind).alias("kind")))
    return P.parse_routed(M.union_all(frames), validate_ips=validate_ips) if frames else None


def ingest(spark: SparkSession, inputs: dict | str | DataFrame, root: str, mode: str = "overwrite",
           validate_ips: bool = True, batch: str | None = None, rebalance: bool = False) -> IngestResult:
    """Parse raw text of each kind and load it as one batch.

    ``inputs`` maps a kind (``access``, ``dataxceiver``, ``namesystem``) to a path (or a
    DataFrame of lines), or is a folder of files under their default names, read in one
    scan, or a DataFrame of lines ``value`` with their ``kind``; unknown kinds are skipped. ``batch`` names the load, so that
    running it again adds nothing. Log files come in time order, so each task writes
    its own few days and nothing is shuffled; rows are sorted by the partition
    columns and the action id within the task, which keeps one open file per task and
    lets readers skip row groups. ``rebalance`` shuffles by partition instead, for
    inputs that are not in time order.
    """
    typed = _typed_all(spark, inputs, validate_ips)
    if typed is None:
        raise ValueError("no input of a known log kind")
    w = M.to_wide(typed, id_col=F.lit(None).cast("string"), extra=["_line", "reject_reason", "kind", "first_of_line"])
    ok = F.col("reject_reason").isNull()
    routed = w.select(
        *[c for c in w.columns if c not in ("id", "_line", "kind")],
        F.when(~ok, F.col("_line")).alias("_line_out"), F.when(~ok, F.col("kind")).alias("kind_out"),
        F.when(ok, F.lit("ok")).otherwise(F.lit("rejected")).alias("status"),
    ).withColumnRenamed("_line_out", "_line").withColumnRenamed("kind_out", "kind")
    if rebalance:
        routed = routed.hint("rebalance", "status", "log_type_id", "log_date")
    # The id is drawn in the write task: a retried task draws new ids for rows whose
    # earlier attempt was never committed.
    both = (routed.withColumn("id", F.when(F.col("status") == "ok", random_id()))
                  .sortWithinPartitions("status", "log_type_id", "log_date", "action_type_id"))
    n = _commit(spark, root, both, mode, batch)
    return IngestResult(read_store(spark, root), read_rejects(spark, root), root, n["ok_rows"], n["rejected_rows"])


def _store_rows(rows: DataFrame) -> DataFrame:
    """Accepted wide rows in the store's form."""
    none = F.lit(None).cast("string")
    detail = F.col("has_detail") if "has_detail" in rows.columns else F.lit(None).cast("boolean")
    return rows.select(*S.ENTRY_FIELDS, *S.DETAIL_VALUE_FIELDS, detail.alias("has_detail"), "action_name", "log_date",
                       none.alias("_line"), none.alias("reject_reason"), none.alias("kind"),
                       F.lit(None).cast("long").alias("copies"), F.lit("ok").alias("status"))


def append_wide(accepted: DataFrame, root: str, batch: str | None = None) -> int:
    """Append wide rows (e.g. from ``append_logs``) as one batch; rows added."""
    rows = _store_rows(accepted).sortWithinPartitions("log_type_id", "log_date", "action_type_id")
    return _commit(accepted.sparkSession, root, rows, "append", batch)["ok_rows"]


def load_tables(t: M.Tables, root: str, mode: str = "overwrite", batch: str | None = None) -> dict:
    """Load separate tables (e.g. staged CSVs) into the store; accepted rows by table, and rejected rows.

    Constraints hold on what is loaded (see ``operators.reconcile``): rows that break one are
    stored as rejects with the reason, ``kind`` naming their table. Both dimensions are loaded
    as given. With ``mode="append"`` the store's own rows count as given too.
    """
    spark = t.log_entry.sparkSession
    have = read_store(spark, root) if mode == "append" and _exists(spark, f"{root}/batches") else None
    r = reconcile(t, have)
    typed = {f.name: f.dataType for f in WIDE_SCHEMA.fields}
    ok = _store_rows(r.wide)
    given = {"_line": "line", "reject_reason": "reason", "kind": "table", "copies": "copies"}
    bad = r.rejects.select(*[
        F.lit("rejected").alias(c) if c == "status" else F.col(given[c]).alias(c) if c in given
        else F.lit(None).cast(typed[c]).alias(c) for c in ok.columns])
    rows = ok.unionByName(bad).sortWithinPartitions("status", "log_type_id", "log_date", "action_type_id")
    n = _commit(spark, root, rows, mode, batch, r.action_type, r.log_type)
    return {"log_type": n["new_types"], "action_type": n["new_names"], "log_entry": n["ok_rows"],
            "log_access_detail": n["details"], "rejected": n["rejected_rows"]}


def merge_batches(spark: SparkSession, root: str, batch: str | None = None) -> int:
    """Rewrite the visible batches as one, so that readers open few paths; rows rewritten.

    The old batches stay readable until the merge's commit row is there, and batches
    committed meanwhile stay visible beside it. Ids of merged batches are still known, so
    a replayed load adds nothing. Rows are shuffled by their partition, in parts of the advisory
    size.
    """
    log = _log(spark, root)
    old = _visible(log)
    columns = [f.name for f in _without_batch().fields]
    rows = M.union_all(_read_status(spark, root, s, c, old).select(*columns)
                       for s, c in (("ok", "ok_rows"), ("rejected", "rejected_rows")))
    rows = (rows.hint("rebalance", "status", "log_type_id", "log_date")
            .sortWithinPartitions("status", "log_type_id", "log_date", "action_type_id"))
    n = _commit(spark, root, rows, "append", batch, _read_actions(spark, root, old), _read_types(spark, root, old),
                covers=max(r["seq"] for r in log))
    return n["ok_rows"] + n["rejected_rows"]


# --- readers ------------------------------------------------------------------------

def _read_parts(spark: SparkSession, root: str, name: str, schema, batches: list) -> DataFrame:
    """Rows of a small table of the given batches."""
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{name}/batch={r['batch']}" for r in batches])


def _read_actions(spark: SparkSession, root: str, batches: list) -> DataFrame:
    return _read_parts(spark, root, "action_type", S.ACTION_TYPE, [r for r in batches if r["new_names"]])


def _read_types(spark: SparkSession, root: str, batches: list) -> DataFrame:
    return _read_parts(spark, root, "log_type", S.LOG_TYPE, [r for r in batches if r["new_types"]])


def _read_status(spark: SparkSession, root: str, status: str, count: str, batches: list | None = None) -> DataFrame:
    batches = committed(spark, root) if batches is None else batches
    paths = [f"{root}/parsed/batch={r['batch']}/status={status}" for r in batches if r[count]]
    if not paths:  # committed loads without a row of this kind
        return spark.createDataFrame([], WIDE_SCHEMA)
    return spark.read.schema(WIDE_SCHEMA).option("basePath", f"{root}/parsed").parquet(*paths)


def read_wide(spark: SparkSession, root: str, batches: list | None = None) -> DataFrame:
    return _read_status(spark, root, "ok", "ok_rows", batches).select(
        *S.ENTRY_FIELDS, *S.DETAIL_VALUE_FIELDS, "has_detail", "action_name", "log_date")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Rejected rows: kind (of log, or the table's name), line, reason, and how many equal ones."""
    return _read_status(spark, root, "rejected", "rejected_rows").select(
        "kind", "log_type_id", F.col("_line").alias("line"), F.col("reject_reason").alias("reason"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"))


def read_stats(spark: SparkSession, root: str) -> DataFrame:
    """P10/P11 of each load of log text: batch, kind, total_lines, matched_lines, rows."""
    old = _log(spark, root)
    days = spark.read.schema(T.StructType([*DAYS.fields, T.StructField("batch", T.StringType())])) \
        .option("basePath", f"{root}/days").parquet(*[f"{root}/days/batch={r['batch']}" for r in old
                                                      if r["covers"] is None])
    kind = F.create_map(*[F.lit(x).cast("short") if isinstance(x, int) else F.lit(x)
                          for kv in KIND_OF_TYPE.items() for x in kv])
    return (days.filter("total_lines > 0").groupBy("batch", kind[F.col("log_type_id")].alias("kind"))
            .agg(F.sum("total_lines").alias("total_lines"), F.sum("matched_lines").alias("matched_lines"),
                 F.sum(F.when(F.col("status") == "ok", F.col("rows")).otherwise(0)).alias("rows")))


def read_rollups(spark: SparkSession, root: str, batches: list | None = None) -> M.Rollups:
    """Rows by day, type and action, and actions by day and block, of the visible batches."""
    batches = committed(spark, root) if batches is None else batches
    days = _read_parts(spark, root, "days", DAYS, batches).filter("status = 'ok'")
    return M.Rollups(days.select("log_date", "log_type_id", "action_type_id", "rows"),
                     _read_parts(spark, root, "blocks", BLOCKS, batches))


def read_store(spark: SparkSession, root: str) -> M.Tables:
    """The four tables of a store (wide layout)."""
    batches = committed(spark, root)
    t = M.Tables.from_wide(_read_types(spark, root, batches), _read_actions(spark, root, batches),
                           read_wide(spark, root, batches))
    t.rollups = read_rollups(spark, root, batches)
    return t
