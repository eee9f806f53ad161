"""Log data derived by Spark from the driver's ``events`` table.

The driver ships no server logs, so two derivations of ``events`` stand in
for them (every event becomes log data; work grows with the table):

* :func:`fixture_tables` - the four-table model directly (even event ids are
  ACCESS entries with a detail row, odd ids are HDFS entries);
* :func:`fixture_lines` - raw log *text* (seven line shapes by event id,
  one of them a reject), to be parsed like real files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schema as S
from ..operators.model import Tables, action_type_table, known_rows, log_type_table

# --- fixed values: event type -> action name --------------------------------
ACCESS_ACTION = {"view": "GET", "click": "POST", "purchase": "PUT", "signup": "HEAD"}
ACCESS_ACTION_ELSE = "DELETE"
HDFS_ACTION = {"view": "receiving", "click": "received", "purchase": "served",
               "signup": "update"}
HDFS_ACTION_ELSE = "replicate"
FIXTURE_ACTIONS = ["GET", "POST", "PUT", "HEAD", "DELETE",
                   "receiving", "received", "served", "update", "replicate"]
# Line shapes by event_id % 7 and the log file kind each belongs to.
LINE_KIND = {0: "access", 1: "dataxceiver", 2: "dataxceiver", 3: "dataxceiver",
             4: "namesystem", 5: "namesystem", 6: "dataxceiver"}
# ---------------------------------------------------------------------------


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _case(col: Column, mapping: dict, default: str) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, v) if out is None else out.when(col == k, v))
    return out.otherwise(default)


def fixture_action_type(spark: SparkSession) -> DataFrame:
    return action_type_table(known_rows(spark, [(n,) for n in FIXTURE_ACTIONS],
                                        StructType([StructField("name", StringType())])))


def fixture_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows (entry + detail + action_name + log_date) from ``events``."""
    ev = read_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    even = (F.col("event_id") % 2) == 0
    name = F.when(even, _case(F.col("event_type"), ACCESS_ACTION, ACCESS_ACTION_ELSE)) \
            .otherwise(_case(F.col("event_type"), HDFS_ACTION, HDFS_ACTION_ELSE))
    raw = ev.select("event_id", "ts", "user_id", "value", name.alias("action_name"))
    # ten rows: an exchange by name would put all events into as many tasks at most
    act = F.broadcast(fixture_action_type(spark))
    j = raw.join(act, raw["action_name"] == act["name"], "inner")
    uid = F.col("user_id")
    odd = ~even
    return j.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        F.when(even, 1).when(F.col("action_name").isin("update", "replicate"), 3)
         .otherwise(2).cast("short").alias("log_type_id"),
        act["id"].alias("action_type_id"),
        F.col("ts").alias("log_timestamp"),
        F.concat(F.lit("10.0."), F.floor(uid / 250).cast("int").cast("string"), F.lit("."),
                 (uid % 250).cast("string")).alias("source_ip"),
        F.when(odd, F.lit("10.1.0.1")).alias("dest_ip"),
        F.when(odd, uid).alias("block_id"),
        F.when(F.col("event_id") % 10 != 0, F.floor(F.col("value")).cast("bigint"))
         .alias("size_bytes"),
        F.when(even, F.lit("-")).alias("remote_name"),
        F.when(even, F.lit("-")).alias("auth_user"),
        F.when(even, F.concat(F.lit("/r/"), (uid % 37).cast("string"))).alias("resource"),
        F.when(even, F.lit(200)).alias("http_status"),
        F.when(even & (uid % 5 != 0),
               F.concat(F.lit("http://ref/"), (uid % 11).cast("string"))).alias("referrer"),
        F.when(even, F.concat(F.lit("Mozilla/"), (4 + uid % 3).cast("string"),
                              F.lit(".0 (X11)"))).alias("user_agent"),
        F.col("action_name"),
        F.to_date(F.col("ts")).alias("log_date"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The four-table model over ``events`` (wide layout)."""
    return Tables.from_wide(log_type_table(spark), fixture_action_type(spark),
                            fixture_wide(spark, sf_dir))


def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, kind, line)``: one raw log line per event."""
    ev = read_events(spark, sf_dir)
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    s = lambda c: c.cast("string")
    acc = F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss")
    hdfs = F.date_format(ts, "yyMMdd HHmmss")
    even = (eid % 2) == 0
    method = F.when(F.col("event_type") == "view", "GET") \
              .when(F.col("event_type") == "click", "POST").otherwise("HEAD")
    size = F.when(even, F.lit("-")).otherwise(s(F.floor(F.col("value")).cast("bigint")))
    ref = F.when(uid % 5 == 0, F.lit("-")).otherwise(F.lit("http://ref/"))
    shape = eid % 7
    line = (
        F.when(shape == 0, F.concat(
            F.lit("10.0.0."), s(uid % 250), F.lit(" - - ["), acc, F.lit(' +0300] "'), method,
            F.lit(" /r/"), s(uid % 37), F.lit(' HTTP/1.1" 200 '), size, F.lit(' "'), ref,
            F.lit('" "Mozilla/5.0 (X11)"')))
        .when(shape == 1, F.concat(
            hdfs, F.lit(" 13 INFO dfs.DataNode$DataXceiver: Receiving block blk_-"), s(uid),
            F.lit(" src: /10.1.0.1:50010 dest: /10.1.0.2:50010")))
        .when(shape == 2, F.concat(
            hdfs, F.lit(" 13 INFO dfs.DataNode$DataXceiver: Received block blk_"), s(uid),
            F.lit(" src: /10.1.0.1:50010 dest: /10.1.0.2:50010"),
            F.when(even, F.concat(F.lit(" of size "), s(eid))).otherwise(F.lit(""))))
        .when(shape == 3, F.concat(
            hdfs, F.lit(" 13 INFO dfs.DataNode$DataXceiver: 10.1.0.3:50010 Served block blk_"),
            s(uid), F.lit(" to /10.1.0.4")))
        .when(shape == 4, F.concat(
            hdfs, F.lit(" 26 INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: "
                        "blockMap updated: 10.1.0.5:50010 is added to blk_"), s(uid),
            F.when(even, F.concat(F.lit(" size "), s(eid))).otherwise(F.lit(""))))
        .when(shape == 5, F.concat(
            hdfs, F.lit(" 26 INFO dfs.FSNamesystem: BLOCK* ask 10.1.0.6:50010 to replicate blk_"),
            s(uid), F.lit(" to datanode(s) 10.1.0.7:50010"),
            F.when(even, F.lit(" 10.1.0.8:50010")).otherwise(F.lit(""))))
        .otherwise(F.concat(hdfs, F.lit(" 13 WARN dfs.DataNode$DataXceiver: junk")))
    )
    kind = F.when(shape == 0, "access").when(shape.isin(4, 5), "namesystem") \
            .otherwise("dataxceiver")
    return ev.select(eid.alias("event_id"), kind.alias("kind"), line.alias("line"))


def fixture_lines_of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return fixture_lines(spark, sf_dir).filter(F.col("kind") == kind)
