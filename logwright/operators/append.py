"""Batch insert of new log rows (I1 / Q14) and dimension upsert.

The single-row insert function of the source system becomes a batch
operator: every request row is resolved against the two dimensions by name,
unknown names and values that do not convert are rejected with a reason,
accepted rows get a new random id. Detail values are kept only for ACCESS rows;
for other log types they are discarded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.ids import random_id
from ..functions.timestamps import iso_timestamp
from ..functions.values import is_ip
from .model import Tables, action_type_table

REQUEST_FIELDS = ["log_type_name", "action_type_name", "log_timestamp", "source_ip", "dest_ip",
                  "block_id", "size_bytes", *S.DETAIL_VALUE_FIELDS]
OPTIONAL = set(S.DETAIL_VALUE_FIELDS)

# --- fixed values: messages of the source system -----------------------------
UNKNOWN_LOG_TYPE = "Unknown log_type: "
UNKNOWN_ACTION_TYPE = "Unknown action_type: "
# ---------------------------------------------------------------------------


@dataclass
class AppendResult:
    accepted: DataFrame   # wide rows, ready for ``store.append_wide``
    rejected: DataFrame   # request passthrough columns + reason


def _by_upper_name(dim: DataFrame) -> DataFrame:
    """One row per upper-cased name: the smallest name, then id."""
    return (dim.groupBy(F.upper("name").alias("key"))
               .agg(F.min(F.struct("name", "id")).alias("d")).select("key", "d.id", "d.name"))


def append_logs(t: Tables, requests: DataFrame, keep=(), validate_ips: bool = True,
                ignore_case: bool = False) -> AppendResult:
    """Resolve, validate and shape new rows. Optional detail columns may
    be missing from ``requests`` (they default to NULL). ``ignore_case``
    matches names upper-cased on both sides (F15, the older loader's rule); of
    names that differ in case only the smallest one is used."""
    req = requests
    kinds = {f.name: f.dataType for f in S.LOG_ACCESS_DETAIL.fields}
    for c in REQUEST_FIELDS:
        if c not in req.columns:
            if c not in OPTIONAL:
                raise ValueError(f"missing required column {c}")
            req = req.withColumn(c, F.lit(None).cast(kinds[c]))
    log_types = _by_upper_name(t.log_type) if ignore_case else t.log_type.withColumn("key", F.col("name"))
    actions = _by_upper_name(t.action_type) if ignore_case \
        else t.action_type.withColumn("key", F.col("name"))
    lt = log_types.select(F.col("key").alias("_lt_key"), F.col("id").alias("_lt_id"),
                          F.col("name").alias("_lt_name"))
    at = actions.select(F.col("key").alias("_at_key"), F.col("id").alias("_at_id"),
                        F.col("name").alias("_at_name"))
    norm = (lambda c: F.upper(F.col(c))) if ignore_case else F.col
    typed = req.select(
        "*", iso_timestamp(F.col("log_timestamp").cast("string")).alias("_ts")
        if dict(req.dtypes)["log_timestamp"] == "string"
        else F.col("log_timestamp").cast("timestamp").alias("_ts"),
        F.col("block_id").try_cast("bigint").alias("_block"),
        F.col("size_bytes").try_cast("bigint").alias("_size"),
        F.col("http_status").try_cast("int").alias("_status"))
    j = (typed.join(lt, norm("log_type_name") == F.col("_lt_key"), "left")
              .join(at, norm("action_type_name") == F.col("_at_key"), "left"))
    lost = lambda raw, value: F.col(raw).isNotNull() & F.col(value).isNull()
    reason = (F.when(F.col("_lt_id").isNull(),
                     F.concat(F.lit(UNKNOWN_LOG_TYPE), F.coalesce("log_type_name", F.lit(""))))
               .when(F.col("_at_id").isNull(),
                     F.concat(F.lit(UNKNOWN_ACTION_TYPE), F.coalesce("action_type_name", F.lit(""))))
               .when(F.col("log_timestamp").isNull(), F.lit("log_timestamp is required"))
               .when(F.col("_ts").isNull(), F.lit("invalid log_timestamp"))
               .when(lost("block_id", "_block"), F.lit("invalid block_id"))
               .when(lost("size_bytes", "_size"), F.lit("invalid size_bytes"))
               .when(lost("http_status", "_status"), F.lit("invalid http_status")))
    if validate_ips:
        for c in ("source_ip", "dest_ip"):
            reason = reason.when(F.col(c).isNotNull() & ~is_ip(F.col(c)), F.lit(f"invalid {c}"))
    j = j.withColumn("_reason", reason)
    is_access = F.col("_lt_name") == F.lit("ACCESS")
    detail = {c: F.col("_status") if c == "http_status" else F.col(c) for c in S.DETAIL_VALUE_FIELDS}
    accepted = j.filter(F.col("_reason").isNull()).select(
        *keep,
        random_id().alias("id"),
        F.col("_lt_id").cast("short").alias("log_type_id"),
        F.col("_at_id").alias("action_type_id"),
        F.col("_ts").alias("log_timestamp"),
        "source_ip", "dest_ip", F.col("_block").alias("block_id"), F.col("_size").alias("size_bytes"),
        *[F.when(is_access, v).alias(c) for c, v in detail.items()],
        F.col("_at_name").alias("action_name"),
        F.to_date("_ts").alias("log_date"),
    )
    rejected = j.filter(F.col("_reason").isNotNull()).select(*keep, F.col("_reason").alias("reason"))
    return AppendResult(accepted, rejected)


def upsert_action_types(existing: DataFrame, names: DataFrame) -> DataFrame:
    """Rows to add so that every name in ``names`` exists (insert
    ... on conflict do nothing): new names only, with deterministic ids."""
    new = names.select("name").filter(F.col("name").isNotNull()).distinct()
    return action_type_table(new.join(existing.select("name"), "name", "left_anti"))
