"""The catalog as SQL: views of the four tables and one table function per query (2.11, C1).

``register`` defines temporary views and ``CREATE TEMPORARY FUNCTION ... RETURNS TABLE`` functions
over them, so the catalog can be called from any SQL text::

    SELECT * FROM fn_logs_per_day_for_action('GET', '2024-01-01', '2024-02-01')

Constant arguments are folded into the function's body: time bounds reach the Parquet scan as pushed
filters and prune ``log_date`` folders, a limit becomes a top-k. ``call`` binds a catalog entry's
arguments as parameters, never by text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.model import Tables, has_detail

# --- fixed values: names and parameters of the source system's functions and views ----------
SIGNATURES = {
    1: ("fn_total_logs_per_action_type", "p_start {ts}, p_end {ts}"),
    2: ("fn_logs_per_day_for_action", "p_action_name STRING, p_start {ts}, p_end {ts}"),
    3: ("fn_most_common_action_per_source_ip", "p_day DATE"),
    4: ("fn_top_blocks_by_actions_per_day", "p_start DATE, p_end DATE, p_limit INT DEFAULT 5"),
    5: ("fn_referrers_multiple_resources", ""),
    6: ("fn_second_most_common_resource", ""),
    7: ("fn_access_logs_below_size", "p_max_size BIGINT"),
    8: ("fn_blocks_rep_and_serv_same_day", ""),
    9: ("fn_blocks_rep_and_serv_same_day_hour", ""),
    10: ("fn_access_logs_by_user_agent_version", "p_version STRING"),
    11: ("fn_ips_with_method_in_range", "p_log_type_name STRING, p_http_method STRING, p_start {ts}, p_end {ts}"),
    12: ("fn_ips_with_two_methods_in_range",
         "p_log_type_name STRING, p_method1 STRING, p_method2 STRING, p_start {ts}, p_end {ts}"),
    13: ("fn_ips_with_n_methods_in_range", "p_log_type_name STRING, p_required_methods INT, p_start {ts}, p_end {ts}"),
}
VIEWS = {5: "v_referrers_multiple_resources", 6: "v_second_most_common_resource",
         8: "v_blocks_rep_and_serv_same_day", 9: "v_blocks_rep_and_serv_same_day_hour"}
# ---------------------------------------------------------------------------

_ALL_14 = S.ENTRY_FIELDS + S.DETAIL_VALUE_FIELDS
RETURNS = {
    1: "action_type_name STRING, logs BIGINT", 2: "day DATE, total_logs BIGINT",
    3: "source_ip STRING, action_type_name STRING, frequency BIGINT", 4: "block_id BIGINT, day DATE, total_actions BIGINT",
    5: "referrer STRING, resource_frequency BIGINT", 6: "resource STRING, frequency BIGINT", 7: "{all}",
    8: "block_id BIGINT", 9: "block_id BIGINT", 10: "{all}", 11: "source_ip STRING", 12: "source_ip STRING",
    13: "source_ip STRING, cnt INT, methods STRING"}

_CLOSED = """log_timestamp BETWEEN p_start AND p_end
      AND log_date BETWEEN CAST(p_start AS DATE) AND CAST(p_end AS DATE)"""
_HALF_OPEN = """log_timestamp >= p_start AND log_timestamp < p_end
      AND log_date BETWEEN CAST(p_start AS DATE) AND CAST(p_end AS DATE)"""
# entries of one log type in a range, with the action's name
_TYPED = f"""(SELECT e.source_ip, a.name AS method FROM {{e}} e
    JOIN log_type t ON t.id = e.log_type_id AND t.name = p_log_type_name
    JOIN action_type a ON a.id = e.action_type_id
    WHERE {_HALF_OPEN})"""
# blocks that have both actions within one value of a time key
_BOTH = """SELECT block_id FROM (
    SELECT e.block_id, {key}, bool_or(a.name = 'replicate') AND bool_or(a.name = 'served') AS found
    FROM {{e}} e JOIN action_type a ON a.id = e.action_type_id AND a.name IN ('replicate', 'served')
    GROUP BY e.block_id, {key}) g
  WHERE found ORDER BY block_id DESC NULLS FIRST"""

BODIES = {
    1: f"""SELECT a.name AS action_type_name, SUM(c.n) AS logs FROM (
      SELECT action_type_id, COUNT(*) AS n FROM {{e}} WHERE {_CLOSED} GROUP BY action_type_id) c
    JOIN action_type a ON a.id = c.action_type_id GROUP BY a.name ORDER BY logs DESC, action_type_name""",
    2: f"""SELECT CAST(e.log_timestamp AS DATE) AS day, COUNT(*) AS total_logs FROM {{e}} e
    JOIN action_type a ON a.id = e.action_type_id AND a.name = p_action_name
    WHERE {_CLOSED} GROUP BY CAST(e.log_timestamp AS DATE) ORDER BY total_logs DESC, day""",
    3: """SELECT source_ip, action_type_name, frequency FROM (
      SELECT c.source_ip, a.name AS action_type_name, SUM(c.n) AS frequency,
        RANK() OVER (PARTITION BY c.source_ip ORDER BY SUM(c.n) DESC) AS place
      FROM (SELECT source_ip, action_type_id, COUNT(*) AS n FROM {e} WHERE log_date = p_day GROUP BY ALL) c
      JOIN action_type a ON a.id = c.action_type_id GROUP BY c.source_ip, a.name) r
    WHERE place = 1 ORDER BY frequency DESC, source_ip, action_type_name""",
    4: """SELECT block_id, day, total_actions FROM (
      SELECT block_id, log_date AS day, COUNT(action_type_id) AS total_actions,
        ROW_NUMBER() OVER (ORDER BY COUNT(action_type_id) DESC, block_id, log_date) AS place
      FROM {e} WHERE log_date >= p_start AND log_date < p_end AND block_id IS NOT NULL
      GROUP BY block_id, log_date) r
    WHERE place <= p_limit ORDER BY place""",
    5: """SELECT referrer, COUNT(resource) AS resource_frequency FROM log_access_detail WHERE referrer IS NOT NULL
    GROUP BY referrer HAVING COUNT(resource) > 1""",
    6: """WITH counts AS (SELECT resource, COUNT(*) AS frequency FROM log_access_detail GROUP BY resource),
    levels AS (SELECT frequency, COUNT(*) AS n FROM counts GROUP BY frequency ORDER BY frequency DESC LIMIT 2)
    SELECT c.resource, c.frequency FROM counts c JOIN (SELECT MIN(frequency) AS second FROM levels
      HAVING COUNT(*) = 2 AND MAX_BY(n, frequency) = 1) l ON c.frequency = l.second""",
    7: """SELECT {cols} FROM {d} WHERE size_bytes < p_max_size""",
    8: _BOTH.format(key="e.log_date"),
    9: _BOTH.format(key="e.log_date, hour(e.log_timestamp)"),
    10: """SELECT {cols} FROM {d} WHERE user_agent ILIKE concat('%Mozilla/', p_version, '%')""",
    11: f"""SELECT DISTINCT source_ip FROM {_TYPED} WHERE method = p_http_method""",
    12: f"""SELECT source_ip FROM (SELECT source_ip, method = p_method1 AS one FROM {_TYPED}
      WHERE method IN (p_method1, p_method2) AND p_method1 <> p_method2) m
    GROUP BY source_ip HAVING bool_or(one) AND bool_or(NOT one)""",
    13: f"""SELECT source_ip, CAST(SIZE(names) AS INT) AS cnt, array_join(array_sort(names), '|') AS methods FROM (
      SELECT source_ip, collect_set(method) AS names FROM (SELECT DISTINCT source_ip, method FROM {_TYPED}) p
      GROUP BY source_ip) s
    WHERE SIZE(names) = p_required_methods ORDER BY source_ip""",
}


def register(spark: SparkSession, t: Tables, prefix: str = "") -> None:
    """Views ``log_type``, ``action_type``, ``log_entry``, ``log_access_detail``, the four views of the
    queries without parameters, and the thirteen table functions, over the tables ``t``.

    ``prefix`` goes before every function's and view's name. Registering again replaces them.
    """
    tables = {"log_type": t.log_type, "action_type": t.action_type, "log_entry": t.log_entry,
              "log_access_detail": t.log_access_detail}
    if t.wide is not None:
        entries, detailed = t.wide.select(*S.ENTRY_FIELDS, "log_date"), t.wide.filter(has_detail(t.wide))
    else:
        entries = t.log_entry.withColumn("log_date", F.to_date("log_timestamp"))
        detailed = t.log_entry.join(t.log_access_detail, F.col("id") == F.col("log_entry_id"))
    named = {**tables, "lw_entries": entries, "lw_detailed": detailed.select(*_ALL_14)}
    for name, df in named.items():
        df.createOrReplaceTempView(prefix + name)
    types = {f.name: f.dataType.simpleString() for f in detailed.schema.fields}
    fill = {"ts": types["log_timestamp"], "all": ", ".join(f"{c} {types[c]}" for c in _ALL_14),
            "cols": ", ".join(_ALL_14), "e": f"{prefix}lw_entries", "d": f"{prefix}lw_detailed"}
    for key, (name, params) in SIGNATURES.items():
        body = BODIES[key].format(**fill)
        for table in tables:  # whole words only: log_type is also the start of log_type_id
            body = body.replace(f"FROM {table} ", f"FROM {prefix}{table} ").replace(f"JOIN {table} ", f"JOIN {prefix}{table} ")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params.format(**fill)}) "
                  f"RETURNS TABLE ({RETURNS[key].format(**fill)}) RETURN {body}")
        if key in VIEWS:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{VIEWS[key]} AS SELECT * FROM {prefix}{name}()")


def call(spark: SparkSession, key: int, *args, prefix: str = "") -> DataFrame:
    """The table function of catalog entry ``key`` on bound arguments (missing ones at the end: their defaults)."""
    marks = ", ".join(f":a{k}" for k in range(len(args)))
    return spark.sql(f"SELECT * FROM {prefix}{SIGNATURES[key][0]}({marks})",
                     args={f"a{k}": v for k, v in enumerate(args)})
