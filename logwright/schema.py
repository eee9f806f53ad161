"""Typed data model: one fact table, one 1:1 detail table, two lookups.

Column lists and types follow the relational model of the log store:
``log_type`` and ``action_type`` are dimensions, ``log_entry`` is the fact
table and ``log_access_detail`` extends ACCESS entries one to one.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source system's) -------------------------
# Log types in id order; ids are 1-based positions in this tuple.
LOG_TYPE_NAMES = ("ACCESS", "HDFS_DATAXCEIVER", "HDFS_NAMESYSTEM")
# Namespace of the name-based (version 5) action-type ids.
ACTION_NAMESPACE = "12345678-1234-5678-1234-567812345678"
# Action names produced by the HDFS parsers.
HDFS_ACTIONS = ("receiving", "received", "served", "update", "replicate")
# ---------------------------------------------------------------------------

ACCESS, HDFS_DATAXCEIVER, HDFS_NAMESYSTEM = 1, 2, 3
LOG_TYPE_IDS = {name: i for i, name in enumerate(LOG_TYPE_NAMES, start=1)}

LOG_TYPE = T.StructType([
    T.StructField("id", T.ShortType(), False),
    T.StructField("name", T.StringType(), False),
])

ACTION_TYPE = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
])

LOG_ENTRY = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("log_type_id", T.ShortType(), False),
    T.StructField("action_type_id", T.StringType(), True),
    T.StructField("log_timestamp", T.TimestampType(), False),
    T.StructField("source_ip", T.StringType(), True),
    T.StructField("dest_ip", T.StringType(), True),
    T.StructField("block_id", T.LongType(), True),
    T.StructField("size_bytes", T.LongType(), True),
])

LOG_ACCESS_DETAIL = T.StructType([
    T.StructField("log_entry_id", T.StringType(), False),
    T.StructField("remote_name", T.StringType(), True),
    T.StructField("auth_user", T.StringType(), True),
    T.StructField("resource", T.StringType(), True),
    T.StructField("http_status", T.IntegerType(), True),
    T.StructField("referrer", T.StringType(), True),
    T.StructField("user_agent", T.StringType(), True),
])

USER_QUERY_LOG = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("query_text", T.StringType(), False),
    T.StructField("params", T.StringType(), True),
    T.StructField("executed_at", T.TimestampType(), False),
])

ALL_TABLES = {"log_type": LOG_TYPE, "action_type": ACTION_TYPE, "log_entry": LOG_ENTRY,
              "log_access_detail": LOG_ACCESS_DETAIL}

ENTRY_FIELDS = [f.name for f in LOG_ENTRY.fields]
DETAIL_FIELDS = [f.name for f in LOG_ACCESS_DETAIL.fields]
DETAIL_VALUE_FIELDS = DETAIL_FIELDS[1:]

# Columns of a parsed record before ids are attached: the entry columns with
# the action as a name, plus the access detail columns (NULL for HDFS rows).
PARSED = T.StructType([
    T.StructField("log_type_id", T.ShortType(), False),
    T.StructField("action_name", T.StringType(), True),
    T.StructField("log_timestamp", T.TimestampType(), True),
    T.StructField("source_ip", T.StringType(), True),
    T.StructField("dest_ip", T.StringType(), True),
    T.StructField("block_id", T.LongType(), True),
    T.StructField("size_bytes", T.LongType(), True),
    *LOG_ACCESS_DETAIL.fields[1:],
])
PARSED_FIELDS = [f.name for f in PARSED.fields]
