"""Registered queries over driver data, each with its DuckDB oracle.

Keys follow the operator ids of the blueprint (q = query catalog, p = parse,
m = model, k = integrity, i = insert, f = scalar functions, x = archived
variants, e2e = text to answer). Parameters are the fixture bindings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.timestamps import as_wall_clock
from ..session import scratch_path
from ..operators import model as M
from ..operators import parse as P
from ..sources import fixture_sql as O
from ..sources.fixtures import fixture_lines, fixture_lines_of, fixture_tables
from . import queries as Q

# --- fixture bindings -------------------------------------------------------
Q01 = ("2024-01-05 00:00:00", "2024-01-10 00:00:00")
Q02 = ("GET", "2024-01-02 00:00:00", "2024-01-12 00:00:00")
Q03 = "2024-01-05"
Q04 = ("2024-01-02", "2024-01-20", 5)
Q07 = 5
Q10 = "5.0"
Q11 = ("ACCESS", "GET", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
Q12 = ("ACCESS", "GET", "POST", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
Q13 = ("ACCESS", 4, "2024-01-02 00:00:00", "2024-01-05 00:00:00")

QUERIES: dict = {}
ORACLE: dict = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def _ts(s: str) -> str:
    return f"TIMESTAMP '{s}'"


# --- Q1-Q13 on the four-table projection -------------------------------------

@register("q01_total_logs_per_action_type", O.with_model(f"""
SELECT act.name AS action_type_name, CAST(COUNT(*) AS BIGINT) AS logs
FROM log_entry le JOIN action_type act ON act.id = le.action_type_id
WHERE le.log_timestamp BETWEEN {_ts(Q01[0])} AND {_ts(Q01[1])}
GROUP BY act.name ORDER BY logs DESC"""))
def q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.q01_total_logs_per_action_type(fixture_tables(spark, sf_dir), *Q01)


@register("q02_logs_per_day_for_action", O.with_model(f"""
SELECT CAST(le.log_timestamp AS DATE) AS day, CAST(COUNT(*) AS BIGINT) AS total_logs
FROM log_entry le JOIN action_type act ON le.action_type_id = act.id
WHERE act.name = '{Q02[0]}' AND le.log_timestamp BETWEEN {_ts(Q02[1])} AND {_ts(Q02[2])}
GROUP BY CAST(le.log_timestamp AS DATE) ORDER BY total_logs DESC"""))
def q02(spark, sf_dir):
    return Q.q02_logs_per_day_for_action(fixture_tables(spark, sf_dir), *Q02)


@register("q03_most_common_action_per_source_ip", O.with_model(f"""
, per_day AS (SELECT source_ip, action_type_id FROM log_entry
    WHERE log_timestamp >= TIMESTAMP '{Q03} 00:00:00' AND log_timestamp < TIMESTAMP '{Q03} 00:00:00' + INTERVAL 1 DAY),
  tally AS (SELECT source_ip, name, COUNT(*) AS n FROM per_day, action_type
    WHERE action_type.id = action_type_id GROUP BY ALL),
  best AS (SELECT source_ip, MAX(n) AS top FROM tally GROUP BY source_ip)
SELECT tally.source_ip, tally.name AS action_type_name, CAST(tally.n AS BIGINT) AS frequency
FROM tally JOIN best ON tally.n = best.top AND tally.source_ip IS NOT DISTINCT FROM best.source_ip"""
                                                                .replace("\n, per_day", ", per_day", 1)))
def q03(spark, sf_dir):
    return Q.q03_most_common_action_per_source_ip(fixture_tables(spark, sf_dir), Q03)


@register("q04_top_blocks_by_actions_per_day", O.with_model(f"""
SELECT le.block_id AS block_id, CAST(le.log_timestamp AS DATE) AS day,
  CAST(COUNT(le.action_type_id) AS BIGINT) AS total_actions
FROM log_entry le
WHERE CAST(le.log_timestamp AS DATE) >= DATE '{Q04[0]}' AND CAST(le.log_timestamp AS DATE) < DATE '{Q04[1]}'
  AND le.block_id IS NOT NULL
GROUP BY le.block_id, CAST(le.log_timestamp AS DATE)
ORDER BY total_actions DESC, block_id ASC, day ASC LIMIT {Q04[2]}"""))
def q04(spark, sf_dir):
    return Q.q04_top_blocks_by_actions_per_day(fixture_tables(spark, sf_dir), *Q04)


@register("q05_referrers_multiple_resources", O.with_model("""
, named AS (SELECT referrer, resource FROM log_access_detail WHERE referrer IS NOT NULL AND resource IS NOT NULL),
  numbered AS (SELECT referrer, row_number() OVER (PARTITION BY referrer) AS k FROM named)
SELECT referrer, CAST(max(k) AS BIGINT) AS resource_frequency FROM numbered GROUP BY referrer HAVING max(k) >= 2"""
                                                            .replace("\n, named", ", named", 1)))
def q05(spark, sf_dir):
    return Q.q05_referrers_multiple_resources(fixture_tables(spark, sf_dir))


@register("q06_second_most_common_resource", O.with_model("""
, tally AS (SELECT resource, COUNT(*) AS frequency FROM log_access_detail GROUP BY resource)
SELECT x.resource, x.frequency FROM tally x
WHERE (SELECT COUNT(*) FROM tally y WHERE y.frequency > x.frequency) = 1""".replace("\n, tally", ", tally", 1)))
def q06(spark, sf_dir):
    return Q.q06_second_most_common_resource(fixture_tables(spark, sf_dir))


@register("q07_access_logs_below_size", O.with_model(f"""
SELECT {O.ENTRY_DETAIL_COLS}
FROM log_entry le JOIN log_access_detail lad ON le.id = lad.log_entry_id
WHERE le.size_bytes IS NOT NULL AND le.size_bytes < {Q07}"""))
def q07(spark, sf_dir):
    return Q.q07_access_logs_below_size(fixture_tables(spark, sf_dir), Q07)


# Keys that have both actions: the intersection of the two sets of (block, key).
_BOTH = """, of_name AS (SELECT name, block_id, {key} AS k FROM log_entry, action_type
    WHERE action_type.id = action_type_id)
SELECT block_id FROM (
  SELECT block_id, k FROM of_name WHERE name = 'replicate' INTERSECT
  SELECT block_id, k FROM of_name WHERE name = 'served') both_actions"""


@register("q08_blocks_rep_and_serv_same_day", O.with_model(_BOTH.format(key="date_trunc('day', log_timestamp)")))
def q08(spark, sf_dir):
    return Q.q08_blocks_rep_and_serv_same_day(fixture_tables(spark, sf_dir))


@register("q09_blocks_rep_and_serv_same_day_hour", O.with_model(_BOTH.format(key="date_trunc('hour', log_timestamp)")))
def q09(spark, sf_dir):
    return Q.q09_blocks_rep_and_serv_same_day_hour(fixture_tables(spark, sf_dir))


@register("q10_access_logs_by_user_agent_version", O.with_model(f"""
SELECT {O.ENTRY_DETAIL_COLS}
FROM log_entry le JOIN log_access_detail lad ON le.id = lad.log_entry_id
WHERE lad.user_agent ILIKE ('%Mozilla/' || '{Q10}' || '%')"""))
def q10(spark, sf_dir):
    return Q.q10_access_logs_by_user_agent_version(fixture_tables(spark, sf_dir), Q10)


# Access entries of a range with the method's name.
_RANGE = """, used AS (SELECT source_ip, (SELECT name FROM action_type WHERE id = action_type_id) AS method
    FROM log_entry WHERE log_type_id = (SELECT id FROM log_type WHERE name = '{0}')
      AND NOT (log_timestamp < {1}) AND log_timestamp < {2})
"""


@register("q11_ips_with_method_in_range", O.with_model(_RANGE.format(Q11[0], _ts(Q11[2]), _ts(Q11[3])) + f"""
SELECT source_ip FROM used GROUP BY source_ip HAVING bool_or(method = '{Q11[1]}')"""))
def q11(spark, sf_dir):
    return Q.q11_ips_with_method_in_range(fixture_tables(spark, sf_dir), *Q11)


@register("q12_ips_with_two_methods_in_range", O.with_model(_RANGE.format(Q12[0], _ts(Q12[3]), _ts(Q12[4])) + f"""
SELECT source_ip FROM used WHERE method = '{Q12[1]}' INTERSECT SELECT source_ip FROM used WHERE method = '{Q12[2]}'"""))
def q12(spark, sf_dir):
    return Q.q12_ips_with_two_methods_in_range(fixture_tables(spark, sf_dir), *Q12)


@register("q13_ips_with_n_methods_in_range", O.with_model(_RANGE.format(Q13[0], _ts(Q13[2]), _ts(Q13[3])) + f"""
, pairs AS (SELECT DISTINCT source_ip, method FROM used),
  sets AS (SELECT source_ip, list_sort(list(method)) AS m FROM pairs GROUP BY source_ip)
SELECT source_ip, CAST(len(m) AS INTEGER) AS cnt, array_to_string(m, '|') AS methods FROM sets WHERE len(m) = {Q13[1]}"""))
def q13(spark, sf_dir):
    return Q.q13_ips_with_n_methods_in_range(fixture_tables(spark, sf_dir), *Q13)


# --- P1-P11: raw text derived from events, parsed -----------------------------

ENTRY_OUT = ["event_id", "log_type_id", "action_name", "log_timestamp", "source_ip", "dest_ip",
             "block_id", "size_bytes"]
ALL_OUT = ENTRY_OUT + S.DETAIL_VALUE_FIELDS


def _parsed(spark, sf_dir, kind: str) -> DataFrame:
    rows = P.parse_lines(fixture_lines_of(spark, sf_dir, kind), kind, line_col="line",
                         keep=["event_id"]).rows
    return rows.withColumn("log_timestamp", as_wall_clock(F.col("log_timestamp")))


def _parse_key(key: str, kind: str, action: str | None, sql_select: str, cols):
    @register(key, O.with_lines(f"SELECT {', '.join(cols)} FROM ({sql_select}) x"))
    def fn(spark, sf_dir):
        rows = _parsed(spark, sf_dir, kind)
        if action is not None:
            rows = rows.filter(F.col("action_name") == action)
        return rows.select(*cols)
    fn.__name__ = key
    return fn


_parse_key("p01_access", "access", None, O.PARSED_ACCESS, ALL_OUT)
_parse_key("p02_receiving", "dataxceiver", "receiving", O.PARSED_RECEIVING, ENTRY_OUT)
_parse_key("p03_received", "dataxceiver", "received", O.PARSED_RECEIVED, ENTRY_OUT)
_parse_key("p04_served", "dataxceiver", "served", O.PARSED_SERVED, ENTRY_OUT)
_parse_key("p05_update", "namesystem", "update", O.PARSED_UPDATE, ENTRY_OUT)
_parse_key("p06_replicate", "namesystem", "replicate", O.PARSED_REPLICATE, ENTRY_OUT)


def _all_typed(spark, sf_dir) -> DataFrame:
    """All kinds parsed."""
    lines = fixture_lines(spark, sf_dir)
    return M.union_all(
        P.parse_typed(lines.filter(F.col("kind") == k), k, line_col="line", keep=["event_id", "kind"])
        for k in P.KINDS)


@register("p07_rejects", O.with_lines(f"""
SELECT event_id, kind, line, 'no match' AS reason FROM lines WHERE NOT ({O.MATCHED})"""))
def p07(spark, sf_dir):
    return P.rejected(_all_typed(spark, sf_dir), keep=["event_id", "kind"])


@register("p10_match_stats", O.with_lines(f"""
SELECT kind, COUNT(*) AS total_lines, CAST(SUM(CASE WHEN {O.MATCHED} THEN 1 ELSE 0 END) AS BIGINT)
  AS matched_lines FROM lines GROUP BY kind"""))
def p10(spark, sf_dir):
    lines = fixture_lines(spark, sf_dir)
    return M.union_all(P.match_stats(lines.filter(F.col("kind") == k), k, line_col="line",
                                     by=["kind"]) for k in P.KINDS)


@register("p11_rows_per_type", O.with_parsed("""
SELECT log_type_id, COUNT(*) AS rows FROM parsed GROUP BY log_type_id"""))
def p11(spark, sf_dir):
    return P.rows_per_type(P.accepted(_all_typed(spark, sf_dir)))


@register("u01_merge", O.with_parsed(f"SELECT {', '.join(ALL_OUT)} FROM parsed"))
def u01(spark, sf_dir):
    rows = P.accepted(_all_typed(spark, sf_dir), keep=["event_id"])
    return rows.withColumn("log_timestamp", as_wall_clock(F.col("log_timestamp"))).select(*ALL_OUT)


@register("m02_action_type", O.with_parsed(f"""
SELECT {O.uuid5_sql('name')} AS id, name FROM (SELECT DISTINCT action_name AS name FROM parsed) d"""))
def m02(spark, sf_dir):
    rows = P.accepted(_all_typed(spark, sf_dir))
    return M.action_type_table(M.action_names(rows))


# --- flagship: text -> parse -> model -> Q1 ----------------------------------

def model_from_raw(spark: SparkSession, sf_dir: str) -> M.Tables:
    """Parse the derived raw text of all kinds into the wide model.

    Both the facts and the dimension read the parsed rows: of these only the two
    columns that Q1 needs are written, once, to the shared folder."""
    rows = P.accepted(_all_typed(spark, sf_dir)).select("action_name", "log_timestamp", "log_type_id")
    path = scratch_path(spark, "parsed")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    for f in S.PARSED.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    return M.Tables.from_wide(M.log_type_table(spark), M.action_type_table(M.action_names(rows)),
                              M.to_wide(rows))


@register("e2e_q01_from_raw", O.with_parsed(f"""
SELECT action_name AS action_type_name, CAST(COUNT(*) AS BIGINT) AS logs FROM parsed
WHERE log_timestamp BETWEEN {_ts(Q01[0])} AND {_ts(Q01[1])}
GROUP BY action_name ORDER BY logs DESC"""))
def e2e_q01_from_raw(spark, sf_dir):
    return Q.q01_total_logs_per_action_type(model_from_raw(spark, sf_dir), *Q01)


# --- K1-K4 integrity checks on a model with planted violations -----------------
from ..functions.ids import uuid5  # noqa: E402
from ..functions.timestamps import access_timestamp, hdfs_timestamp  # noqa: E402
from ..functions.values import is_ip  # noqa: E402
from ..operators import quality as K  # noqa: E402
from ..operators.append import append_logs, upsert_action_types  # noqa: E402
from ..sources import bucketed, staged_csv, store  # noqa: E402
from ..sources.fixtures import read_events  # noqa: E402
from ..sources.logs import LOG_FILES, default_paths  # noqa: E402
from . import catalog as C  # noqa: E402
from . import sql_functions as SF  # noqa: E402
from . import variants as X  # noqa: E402

# Violations by event id: repeated entries, missing values, unknown keys, details of
# entries that are not ACCESS or do not exist, repeated dimension ids and names.
_PLANTED = """, entry0 AS (SELECT *, CAST(substr(id, 2) AS BIGINT) AS n FROM log_entry),
entry1 AS (SELECT * FROM entry0 UNION ALL SELECT * FROM entry0 WHERE n % 11 = 0),
bad_entry AS (SELECT CASE WHEN n % 13 <> 0 THEN id END AS id, CASE WHEN n % 23 = 0 THEN 9 ELSE log_type_id END AS log_type_id,
  CASE WHEN n % 19 = 0 THEN 'missing' ELSE action_type_id END AS action_type_id,
  CASE WHEN n % 17 <> 0 THEN log_timestamp END AS log_timestamp FROM entry1),
bad_detail AS (SELECT log_entry_id FROM log_access_detail UNION ALL
  SELECT id FROM entry0 WHERE n % 58 = 29 UNION ALL SELECT 'x' || id FROM entry0 WHERE n % 31 = 0),
bad_action AS (SELECT * FROM action_type UNION ALL SELECT id, 'again' FROM action_type WHERE name = 'GET'
  UNION ALL SELECT 'new-id', 'POST'),
bad_type AS (SELECT * FROM log_type UNION ALL SELECT 1, 'ACCESS')
"""


def planted(spark, sf_dir) -> M.Tables:
    """The model over ``events`` with violations of every constraint."""
    t = fixture_tables(spark, sf_dir)
    n = F.substring(F.col("id"), 2, 20).cast("bigint")
    le = t.log_entry.withColumn("_n", n)
    twice = le.unionByName(le.filter(F.col("_n") % 11 == 0))
    bad = twice.select(
        F.when(F.col("_n") % 13 != 0, F.col("id")).alias("id"),
        F.when(F.col("_n") % 23 == 0, F.lit(9)).otherwise(F.col("log_type_id")).cast("short").alias("log_type_id"),
        F.when(F.col("_n") % 19 == 0, "missing").otherwise(F.col("action_type_id")).alias("action_type_id"),
        F.when(F.col("_n") % 17 != 0, F.col("log_timestamp")).alias("log_timestamp"),
        *S.ENTRY_FIELDS[4:])
    extra = (le.filter(F.col("_n") % 58 == 29).select(F.col("id").alias("log_entry_id"))
             .union(le.filter(F.col("_n") % 31 == 0).select(F.concat(F.lit("x"), "id"))))
    act = t.action_type
    actions = (act.union(act.filter("name = 'GET'").select("id", F.lit("again")))
                  .union(spark.createDataFrame([("new-id", "POST")], S.ACTION_TYPE)))
    types = t.log_type.union(spark.createDataFrame([(1, "ACCESS")], S.LOG_TYPE))
    return M.Tables(types, actions, bad, t.log_access_detail.unionByName(extra, allowMissingColumns=True))


def _one(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


@register("k01_dupes", O.with_model(_PLANTED + """
SELECT COUNT(*) AS violations FROM (SELECT id FROM bad_entry WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1) d"""))
def k01(spark, sf_dir):
    return _one(K.duplicate_keys(planted(spark, sf_dir).log_entry.dropna(subset=["id"]), "id"), "violations")


@register("k02_nulls", O.with_model(_PLANTED + """
SELECT COUNT(*) AS violations FROM bad_entry WHERE id IS NULL OR log_type_id IS NULL OR log_timestamp IS NULL"""))
def k02(spark, sf_dir):
    return _one(K.null_violations(planted(spark, sf_dir).log_entry, "id", "log_type_id", "log_timestamp"),
                "violations")


@register("k03_orphans", O.with_model(_PLANTED + """
SELECT COUNT(*) AS violations FROM bad_entry
WHERE action_type_id IS NOT NULL AND action_type_id NOT IN (SELECT id FROM bad_action)"""))
def k03(spark, sf_dir):
    t = planted(spark, sf_dir)
    return _one(K.orphans(t.log_entry, "action_type_id", t.action_type, "id"), "violations")


@register("k04_detail_scope", O.with_model(_PLANTED + """
SELECT COUNT(*) AS violations FROM bad_detail
WHERE log_entry_id NOT IN (SELECT id FROM bad_entry WHERE log_type_id = 1 AND id IS NOT NULL)"""))
def k04(spark, sf_dir):
    return _one(K.detail_scope_violations(planted(spark, sf_dir)), "violations")


def _k_sql() -> str:
    real = {"log_type": "bad_type", "action_type": "bad_action", "log_entry": "bad_entry",
            "log_access_detail": "bad_detail"}
    parts = [f"SELECT 'unique {t}({k[0]})' AS \"check\", COUNT(*) AS violations FROM (SELECT {k[0]} FROM {real[t]} "
             f"WHERE {k[0]} IS NOT NULL GROUP BY {k[0]} HAVING COUNT(*) > 1) d" for t, k in K.UNIQUE]
    parts += [f"SELECT 'not null {t}({f.name})', COUNT(*) FROM {real[t]} WHERE {f.name} IS NULL"
              for t, schema in S.ALL_TABLES.items() for f in schema.fields if not f.nullable]
    parts += [f"SELECT 'foreign key {t}({c})', COUNT(*) FROM {real[t]} WHERE {c} IS NOT NULL AND {c} NOT IN "
              f"(SELECT {k} FROM {real[p]} WHERE {k} IS NOT NULL)" for t, c, p, k in K.FOREIGN]
    parts.append("SELECT 'detail scope', COUNT(*) FROM bad_detail WHERE log_entry_id NOT IN "
                 "(SELECT id FROM bad_entry WHERE log_type_id = 1 AND id IS NOT NULL)")
    return " UNION ALL ".join(parts)


@register("k00_all_constraints", O.with_model(_PLANTED + _k_sql()))
def k00(spark, sf_dir):
    return K.summary(planted(spark, sf_dir))


# --- I1 batch append: insert requests derived from events ---------------------

def _requests(spark, sf_dir) -> DataFrame:
    ev = read_events(spark, sf_dir)
    et, eid, uid = F.col("event_type"), F.col("event_id"), F.col("user_id")
    return ev.select(
        eid.alias("event_id"),
        F.when(et == "error", "SYSLOG").when(eid % 2 == 0, "ACCESS")
         .otherwise("HDFS_DATAXCEIVER").alias("log_type_name"),
        F.when(et == "view", "GET").when(et == "click", "POST").when(et == "purchase", "served")
         .when(et == "signup", "PATCH").otherwise("GET").alias("action_type_name"),
        F.col("ts").alias("log_timestamp"),
        F.concat(F.lit("10.9.0."), (uid % 250).cast("string")).alias("source_ip"),
        F.lit(None).cast("string").alias("dest_ip"),
        F.when(eid % 2 == 1, uid).alias("block_id"),
        F.floor("value").cast("bigint").alias("size_bytes"),
        F.lit("-").alias("remote_name"),
        F.concat(F.lit("u"), (uid % 7).cast("string")).alias("auth_user"),
        F.concat(F.lit("/n/"), (uid % 13).cast("string")).alias("resource"),
        F.lit(201).alias("http_status"),
        F.lit(None).cast("string").alias("referrer"),
        F.lit("curl/8").alias("user_agent"))


REQ_SQL = """, req AS (SELECT event_id, ts, user_id, value,
  CASE WHEN event_type = 'error' THEN 'SYSLOG' WHEN event_id % 2 = 0 THEN 'ACCESS' ELSE 'HDFS_DATAXCEIVER' END AS log_type_name,
  CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'POST' WHEN 'purchase' THEN 'served' WHEN 'signup' THEN 'PATCH' ELSE 'GET' END AS action_type_name
  FROM events)
"""


@register("i01_append_accept", O.with_model(REQ_SQL + """
SELECT r.event_id, lt.id AS log_type_id, act.id AS action_type_id, r.ts AS log_timestamp,
  concat('10.9.0.', CAST(r.user_id % 250 AS VARCHAR)) AS source_ip, CAST(NULL AS VARCHAR) AS dest_ip,
  CASE WHEN r.event_id % 2 = 1 THEN r.user_id END AS block_id, CAST(FLOOR(r.value) AS BIGINT) AS size_bytes,
  CASE WHEN r.log_type_name = 'ACCESS' THEN '-' END AS remote_name,
  CASE WHEN r.log_type_name = 'ACCESS' THEN concat('u', CAST(r.user_id % 7 AS VARCHAR)) END AS auth_user,
  CASE WHEN r.log_type_name = 'ACCESS' THEN concat('/n/', CAST(r.user_id % 13 AS VARCHAR)) END AS resource,
  CASE WHEN r.log_type_name = 'ACCESS' THEN 201 END AS http_status, CAST(NULL AS VARCHAR) AS referrer,
  CASE WHEN r.log_type_name = 'ACCESS' THEN 'curl/8' END AS user_agent,
  act.name AS action_name, CAST(r.ts AS DATE) AS log_date
FROM req r JOIN log_type lt ON lt.name = r.log_type_name JOIN action_type act ON act.name = r.action_type_name"""))
def i01_accept(spark, sf_dir):
    t = fixture_tables(spark, sf_dir)
    acc = append_logs(t, _requests(spark, sf_dir), keep=["event_id"]).accepted.drop("id")
    return acc.withColumn("log_timestamp", as_wall_clock(F.col("log_timestamp")))


@register("i01_append_reject", O.with_model(REQ_SQL + """
SELECT r.event_id, CASE WHEN lt.id IS NULL THEN 'Unknown log_type: ' || r.log_type_name
  ELSE 'Unknown action_type: ' || r.action_type_name END AS reason
FROM req r LEFT JOIN log_type lt ON lt.name = r.log_type_name
  LEFT JOIN action_type act ON act.name = r.action_type_name
WHERE lt.id IS NULL OR act.id IS NULL"""))
def i01_reject(spark, sf_dir):
    t = fixture_tables(spark, sf_dir)
    return append_logs(t, _requests(spark, sf_dir), keep=["event_id"]).rejected


# --- scalar functions over values derived from events -------------------------

@register("f_uuid5", f"""
SELECT name, {O.uuid5_sql('name')} AS id
FROM (SELECT DISTINCT concat(event_type, '-', CAST(user_id % 50 AS VARCHAR)) AS name FROM events) d""")
def f_uuid5(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    names = ev.select(F.concat("event_type", F.lit("-"), (F.col("user_id") % 50).cast("string"))
                      .alias("name")).distinct()
    return names.select("name", uuid5(F.col("name")).alias("id"))


@register("f_ip_valid", """
SELECT event_id, cand, len(string_split(cand, '.')) = 4 AND list_bool_and(list_transform(string_split(cand, '.'),
    lambda x: coalesce(TRY_CAST(x AS INT) BETWEEN 0 AND 255, false) AND CAST(TRY_CAST(x AS INT) AS VARCHAR) = x)) AS valid
FROM (SELECT event_id, concat(CAST(user_id % 300 AS VARCHAR), '.', CAST(event_id % 260 AS VARCHAR), '.0.',
    CAST(user_id % 7 AS VARCHAR)) AS cand FROM events) c""")
def f_ip_valid(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    cand = F.concat((F.col("user_id") % 300).cast("string"), F.lit("."),
                    (F.col("event_id") % 260).cast("string"), F.lit(".0."),
                    (F.col("user_id") % 7).cast("string"))
    return ev.select("event_id", cand.alias("cand")).select("event_id", "cand",
                                                            is_ip(F.col("cand")).alias("valid"))


@register("f_ipv6_valid", """
SELECT event_id, user_id % 9 + event_id % 9 <= 7 AS valid FROM events""")
def f_ipv6_valid(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    side = lambda c: F.array_join(F.array_repeat(F.lit("ab1"), (F.col(c) % 9).cast("int")), ":")
    return ev.select("event_id", is_ip(F.concat(side("user_id"), F.lit("::"), side("event_id"))).alias("valid"))


@register("f_timestamps", """
SELECT event_id,
  date_trunc('second', ts) - to_minutes(CASE event_id % 3 WHEN 0 THEN 180 WHEN 1 THEN -480 ELSE 0 END) AS access_ts,
  date_trunc('second', ts) AS hdfs_ts FROM events""")
def f_timestamps(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    off = F.when(F.col("event_id") % 3 == 0, "+0300").when(F.col("event_id") % 3 == 1, "-0800") \
           .otherwise("+0000")
    stamp = F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" "), off)
    return ev.select(
        "event_id",
        as_wall_clock(access_timestamp(stamp)).alias("access_ts"),
        as_wall_clock(hdfs_timestamp(F.date_format("ts", "yyMMdd"),
                                     F.date_format("ts", "HHmmss"))).alias("hdfs_ts"))


# --- archived variants -------------------------------------------------------

@register("x06_offset_limit", O.with_model("""
, tally AS (SELECT resource, COUNT(*) AS frequency FROM log_access_detail GROUP BY resource)
SELECT resource, frequency FROM tally
QUALIFY row_number() OVER (ORDER BY frequency DESC, resource ASC NULLS FIRST) = 2""".replace("\n, tally", ", tally", 1)))
def x06(spark, sf_dir):
    return X.second_resource_offset(fixture_tables(spark, sf_dir))


@register("x09_text_key", O.with_model(_BOTH.format(
    key="strftime(log_timestamp, '%Y-%m-%d') || CAST(hour(log_timestamp) AS VARCHAR)")))
def x09(spark, sf_dir):
    return X.blocks_same_day_hour_text_key(fixture_tables(spark, sf_dir))


# --- entry joined with detail on separate frames (J3) ---------------------------

def _separate(spark, sf_dir) -> M.Tables:
    t = fixture_tables(spark, sf_dir)
    return M.Tables(t.log_type, t.action_type, t.log_entry, t.log_access_detail)


@register("j03_q07_join", ORACLE["q07_access_logs_below_size"])
def j03_q07(spark, sf_dir):
    return Q.q07_access_logs_below_size(_separate(spark, sf_dir), Q07)


@register("j03_q10_join", ORACLE["q10_access_logs_by_user_agent_version"])
def j03_q10(spark, sf_dir):
    return Q.q10_access_logs_by_user_agent_version(_separate(spark, sf_dir), Q10)


# --- dimension with two ids for one name ------------------------------------------

_TWO_IDS = """, ids2 AS (SELECT CASE WHEN CAST(substr(id, 2) AS BIGINT) % 3 = 0 THEN 'second-' || action_type_id
    ELSE action_type_id END AS aid, source_ip, log_timestamp FROM log_entry),
names2 AS (SELECT id, name FROM action_type UNION ALL SELECT 'second-' || id, name FROM action_type)
"""


def _two_ids(spark, sf_dir) -> M.Tables:
    t = fixture_tables(spark, sf_dir)
    n = F.substring(F.col("id"), 2, 20).cast("bigint")
    wide = t.wide.withColumn("action_type_id", F.when(n % 3 == 0, F.concat(F.lit("second-"), "action_type_id"))
                             .otherwise(F.col("action_type_id")))
    dim = t.action_type.union(t.action_type.select(F.concat(F.lit("second-"), "id"), "name"))
    return M.Tables.from_wide(t.log_type, dim, wide)


@register("q01_two_ids_per_name", O.with_model(_TWO_IDS + f"""
SELECT name AS action_type_name, CAST(COUNT(*) AS BIGINT) AS logs FROM ids2, names2
WHERE aid = names2.id AND log_timestamp BETWEEN {_ts(Q01[0])} AND {_ts(Q01[1])} GROUP BY name"""))
def q01_two_ids(spark, sf_dir):
    return Q.q01_total_logs_per_action_type(_two_ids(spark, sf_dir), *Q01)


@register("q03_two_ids_per_name", ORACLE["q03_most_common_action_per_source_ip"])
def q03_two_ids(spark, sf_dir):
    return Q.q03_most_common_action_per_source_ip(_two_ids(spark, sf_dir), Q03)


# --- action dimensions: conflict, merge, upsert -----------------------------------

def _dims(spark, sf_dir):
    """Dimensions of the ACCESS and HDFS entries; the second gives r- names other ids."""
    wide = fixture_tables(spark, sf_dir).wide
    a = M.action_type_table(M.action_names(wide.filter("log_type_id = 1")))
    b = M.action_type_table(M.action_names(wide))
    return a, b, b.withColumn("id", F.when(F.col("name").startswith("r"), F.concat(F.lit("x"), "id"))
                              .otherwise(F.col("id")))


@register("a08_uuid_conflict", O.with_model("""
SELECT name, CAST(2 AS BIGINT) AS ids FROM action_type WHERE name IN ('receiving', 'received', 'replicate')"""))
def a08(spark, sf_dir):
    a, b, c = _dims(spark, sf_dir)
    return M.action_id_conflicts(a, b, c)


@register("u02_action_merge", O.with_model("SELECT id, name FROM action_type"))
def u02(spark, sf_dir):
    a, b, _ = _dims(spark, sf_dir)
    return M.merge_action_types(a, b)


@register("m08_upsert", O.with_model("""
SELECT id, name FROM action_type WHERE id NOT IN (SELECT action_type_id FROM log_entry WHERE log_type_id = 1)"""))
def m08(spark, sf_dir):
    a, b, _ = _dims(spark, sf_dir)
    return upsert_action_types(a, b)


# --- insert: values that do not convert, names that differ in case ----------------

@register("i02_append_bad_values", O.with_model("""
SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'invalid log_timestamp' WHEN 2 THEN 'invalid block_id'
  WHEN 3 THEN 'invalid size_bytes' WHEN 4 THEN 'invalid source_ip' WHEN 5 THEN 'invalid http_status' END AS reason
FROM events WHERE event_id % 6 <> 0"""))
def i02(spark, sf_dir):
    eid = F.col("event_id")
    bad = lambda k, value, good: F.when(eid % 6 == k, F.lit(value)).otherwise(good)
    req = read_events(spark, sf_dir).select(
        "event_id", F.lit("ACCESS").alias("log_type_name"), F.lit("GET").alias("action_type_name"),
        bad(1, "not a time", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("log_timestamp"),
        bad(4, "999.1.1.1", F.lit("10.0.0.1")).alias("source_ip"), F.lit("::1").alias("dest_ip"),
        bad(2, "blk", F.lit("7")).alias("block_id"), bad(3, "1e", eid.cast("string")).alias("size_bytes"),
        bad(5, "2xx", F.lit("200")).alias("http_status"))
    return append_logs(fixture_tables(spark, sf_dir), req, keep=["event_id"]).rejected


@register("f15_ignore_case", O.with_model("""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS action_name, CAST(1 AS SMALLINT) AS log_type_id
FROM events"""))
def f15(spark, sf_dir):
    t = fixture_tables(spark, sf_dir)
    lower = t.action_type.select(F.concat(F.lit("low-"), "id"), F.lower("name"))
    t = M.Tables(t.log_type, t.action_type.union(lower), t.log_entry, t.log_access_detail)
    req = read_events(spark, sf_dir).select(
        "event_id", F.lit("Access").alias("log_type_name"),
        F.when(F.col("event_id") % 2 == 0, "gEt").otherwise("post").alias("action_type_name"),
        F.col("ts").alias("log_timestamp"), F.lit(None).cast("string").alias("source_ip"),
        F.lit(None).cast("string").alias("dest_ip"), F.lit(None).cast("bigint").alias("block_id"),
        F.lit(None).cast("bigint").alias("size_bytes"))
    return append_logs(t, req, keep=["event_id"], ignore_case=True).accepted \
        .select("event_id", "action_name", "log_type_id")


# --- store: text files under their default names, two loads, a replay -------------

_STORE_COLS = [c for c in ALL_OUT if c != "event_id"]


def _text_files(spark, sf_dir, root: str, lines: DataFrame) -> dict:
    """Derived raw text under the default file names."""
    for kind in LOG_FILES:
        lines.filter(F.col("kind") == kind).select("line").write.text(f"{root}/{LOG_FILES[kind]}")
    return default_paths(root)


_made: dict = {}


def _once(spark, sf_dir, make):
    """What ``make`` wrote for this session and data: the keys that read it share it."""
    key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
    if key not in _made:
        _made[key] = make(spark, sf_dir)
    return _made[key]


def _loaded(spark, sf_dir) -> str:
    return _once(spark, sf_dir, _two_loads)


def _two_loads(spark, sf_dir) -> str:
    """Store root: even events first, then odd ones, then the second load again."""
    root = scratch_path(spark, "store")
    lines = fixture_lines(spark, sf_dir)
    for rest, name in ((0, "first"), (1, "second")):
        paths = _text_files(spark, sf_dir, f"{root}-{name}", lines.filter(F.col("event_id") % 2 == rest))
        paths["syslog"] = paths["access"]  # an unknown kind is skipped (M7)
        for _ in range(1 + rest):
            store.ingest(spark, paths, root, mode="append", batch=name)
    return root


def _wall(df: DataFrame) -> DataFrame:
    return df.withColumn("log_timestamp", as_wall_clock(F.col("log_timestamp")))


@register("s07_append_replay", O.with_parsed(f"SELECT {', '.join(_STORE_COLS)} FROM parsed"))
def s07(spark, sf_dir):
    return _wall(store.read_wide(spark, _loaded(spark, sf_dir)).select(*_STORE_COLS))


@register("s02_folder", ORACLE["s07_append_replay"])
def s02_folder(spark, sf_dir):
    """One scan of a folder: the three default files, and one of another name, which is skipped."""
    root = scratch_path(spark, "folder")
    lines = fixture_lines(spark, sf_dir)
    _text_files(spark, sf_dir, root, lines)
    lines.select("line").write.text(f"{root}/syslog")
    return _wall(store.ingest(spark, root, f"{root}-store").tables.wide.select(*_STORE_COLS))


@register("s09_store_q01", ORACLE["e2e_q01_from_raw"])
def s09(spark, sf_dir):
    return Q.q01_total_logs_per_action_type(store.read_store(spark, _loaded(spark, sf_dir)), *Q01)


@register("s09_store_rejects", ORACLE["p07_rejects"].replace("SELECT event_id, kind,", "SELECT kind,"))
def s09_rejects(spark, sf_dir):
    return store.read_rejects(spark, _loaded(spark, sf_dir)).select("kind", "line", "reason")


# --- staged CSV: awkward values, written, read, loaded into a store ----------------

def _awkward(spark, sf_dir) -> M.Tables:
    t = fixture_tables(spark, sf_dir)
    w = t.wide.withColumn("user_agent", F.when(F.col("user_agent").isNotNull(), F.concat(
        F.lit('  "'), "user_agent", F.lit('", a\\b  ')))) \
        .withColumn("referrer", F.when(F.col("referrer").isNotNull(), F.concat("referrer", F.lit("\\"))))
    return M.Tables.from_wide(t.log_type, t.action_type, w.withColumn("log_timestamp",
                              F.col("log_timestamp").cast("timestamp")))


_AWKWARD_SQL = """
SELECT le.id, le.log_type_id, le.action_type_id, le.log_timestamp, le.source_ip, le.dest_ip, le.block_id, le.size_bytes,
  lad.remote_name, lad.auth_user, lad.resource, lad.http_status, lad.referrer || chr(92) AS referrer,
  '  "' || lad.user_agent || '", a' || chr(92) || 'b  ' AS user_agent
FROM log_entry le LEFT JOIN log_access_detail lad ON lad.log_entry_id = le.id"""


@register("s03_csv_roundtrip", O.with_model(_AWKWARD_SQL))
def s03(spark, sf_dir):
    folder = scratch_path(spark, "csv")
    staged_csv.write_tables(_awkward(spark, sf_dir), folder)
    t = staged_csv.read_tables(spark, folder).tables
    rows = t.log_entry.join(t.log_access_detail, F.col("id") == F.col("log_entry_id"), "left")
    return _wall(rows.select(*S.ENTRY_FIELDS, *S.DETAIL_VALUE_FIELDS))


@register("s05_csv_to_store", O.with_model(_AWKWARD_SQL))
def s05(spark, sf_dir):
    folder, root = scratch_path(spark, "csv"), scratch_path(spark, "store")
    staged_csv.write_tables(_awkward(spark, sf_dir), folder)
    store.load_tables(staged_csv.read_tables(spark, folder).tables, root)
    return _wall(store.read_wide(spark, root).select(*S.ENTRY_FIELDS, *S.DETAIL_VALUE_FIELDS))


# --- reconciling load: CSVs that break every constraint --------------------------------

_S5_SQL = """, e0 AS (SELECT *, CAST(substr(id, 2) AS BIGINT) AS n FROM log_entry),
types_in AS (SELECT id, name FROM log_type UNION ALL VALUES (9, 'SYSLOG'), (1, 'AGAIN'), (5, 'ACCESS')),
actions_in AS (SELECT id, name FROM action_type UNION ALL SELECT id, 'again' FROM action_type WHERE name = 'GET'
  UNION ALL VALUES ('new-id', 'POST'), ('patch-id', 'PATCH')),
entries_in AS (
  SELECT CASE WHEN n % 13 <> 0 THEN id END AS id,
    CASE WHEN n % 29 = 0 THEN 8 WHEN n % 23 = 0 THEN 9 ELSE log_type_id END AS log_type_id,
    CASE WHEN n % 19 = 0 THEN 'missing' ELSE action_type_id END AS action_type_id,
    CASE WHEN n % 17 <> 0 THEN log_timestamp END AS log_timestamp, source_ip, dest_ip, block_id, size_bytes
  FROM e0, range(0, 3) r(k) WHERE k = 0 OR n % 11 = 0
  UNION ALL SELECT id, log_type_id, action_type_id, log_timestamp, source_ip, dest_ip, block_id, size_bytes - 1
  FROM e0 WHERE n % 7 = 0),
details_in AS (
  SELECT d.* FROM log_access_detail d, range(0, 2) r(k)
  WHERE CAST(substr(log_entry_id, 2) AS BIGINT) % 10 <> 4 AND (k = 0 OR CAST(substr(log_entry_id, 2) AS BIGINT) % 37 = 0)
  UNION ALL SELECT log_entry_id, remote_name, auth_user, '/other', http_status, referrer, user_agent
  FROM log_access_detail WHERE CAST(substr(log_entry_id, 2) AS BIGINT) % 41 = 0
  UNION ALL SELECT id, '-', '-', '/hdfs', 200, NULL, NULL FROM e0 WHERE n % 58 = 29
  UNION ALL SELECT 'x' || id, '-', '-', '/lost', 200, NULL, NULL FROM e0 WHERE n % 31 = 0),
types_1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY name) AS k FROM types_in),
types_2 AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY id) AS k2 FROM types_1 WHERE k = 1),
actions_1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY name) AS k FROM actions_in),
actions_2 AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY id) AS k2 FROM actions_1 WHERE k = 1),
entries_1 AS (SELECT *, CASE WHEN id IS NULL THEN 'id is required' WHEN log_timestamp IS NULL THEN 'log_timestamp is required'
    WHEN log_type_id NOT IN (SELECT id FROM types_2 WHERE k2 = 1) THEN 'no such log_type'
    WHEN action_type_id NOT IN (SELECT id FROM actions_2 WHERE k2 = 1) THEN 'no such action_type' END AS reason FROM entries_in),
entries_2 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY log_type_id NULLS FIRST, action_type_id NULLS FIRST,
    log_timestamp NULLS FIRST, source_ip NULLS FIRST, dest_ip NULLS FIRST, block_id NULLS FIRST, size_bytes NULLS FIRST) AS k
  FROM entries_1 WHERE reason IS NULL),
details_1 AS (SELECT *, row_number() OVER (PARTITION BY log_entry_id ORDER BY remote_name NULLS FIRST, auth_user NULLS FIRST,
    resource NULLS FIRST, http_status NULLS FIRST, referrer NULLS FIRST, user_agent NULLS FIRST) AS k FROM details_in),
details_2 AS (SELECT d.*, e.log_type_id AS t FROM details_1 d LEFT JOIN (SELECT * FROM entries_2 WHERE k = 1) e
    ON e.id = d.log_entry_id WHERE d.k = 1)
"""


def _broken(spark, sf_dir) -> str:
    """A folder of staged CSVs with rows that break every constraint."""
    t = _awkward_times(fixture_tables(spark, sf_dir))
    n = F.substring(F.col("id"), 2, 20).cast("bigint")
    le = t.log_entry.withColumn("n", n)
    thrice = le.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")).filter("k = 0 OR n % 11 = 0")
    bad = thrice.select(
        F.when(F.col("n") % 13 != 0, F.col("id")).alias("id"),
        F.when(F.col("n") % 29 == 0, 8).when(F.col("n") % 23 == 0, 9).otherwise(F.col("log_type_id"))
         .cast("short").alias("log_type_id"),
        F.when(F.col("n") % 19 == 0, "missing").otherwise(F.col("action_type_id")).alias("action_type_id"),
        F.when(F.col("n") % 17 != 0, F.col("log_timestamp")).alias("log_timestamp"), *S.ENTRY_FIELDS[4:])
    other = le.filter("n % 7 = 0").withColumn("size_bytes", F.col("size_bytes") - 1).select(*S.ENTRY_FIELDS)
    d = t.log_access_detail.withColumn("n", F.substring(F.col("log_entry_id"), 2, 20).cast("bigint"))
    kept = d.filter("n % 10 <> 4")
    more = [kept.filter("n % 37 = 0"), d.filter("n % 41 = 0").withColumn("resource", F.lit("/other"))]
    odd = [le.filter("n % 58 = 29").select(F.col("id").alias("log_entry_id"), F.lit("/hdfs").alias("resource")),
           le.filter("n % 31 = 0").select(F.concat(F.lit("x"), "id").alias("log_entry_id"), F.lit("/lost").alias("resource"))]
    odd = [x.select("log_entry_id", F.lit("-").alias("remote_name"), F.lit("-").alias("auth_user"), "resource",
                    F.lit(200).alias("http_status")) for x in odd]
    details = M.union_all([kept, *more, *odd]).select(*S.DETAIL_FIELDS)
    act = t.action_type
    actions = act.union(act.filter("name = 'GET'").select("id", F.lit("again"))) \
        .union(spark.createDataFrame([("new-id", "POST"), ("patch-id", "PATCH")], S.ACTION_TYPE))
    types = t.log_type.union(spark.createDataFrame([(9, "SYSLOG"), (1, "AGAIN"), (5, "ACCESS")], S.LOG_TYPE))
    folder = scratch_path(spark, "broken-csv")
    staged_csv.write_tables(M.Tables(types, actions, bad.union(other), details), folder)
    return folder


def _awkward_times(t: M.Tables) -> M.Tables:
    return M.Tables.from_wide(t.log_type, t.action_type,
                              t.wide.withColumn("log_timestamp", F.col("log_timestamp").cast("timestamp")))


def _reconciled(spark, sf_dir) -> tuple[str, DataFrame]:
    return _once(spark, sf_dir, _load_broken)


def _load_broken(spark, sf_dir) -> tuple[str, DataFrame]:
    """Store root, and the rows that the CSV reader rejected before."""
    staged = staged_csv.read_tables(spark, _broken(spark, sf_dir))
    root = scratch_path(spark, "store")
    store.load_tables(staged.tables, root)
    return root, staged.rejects


@register("s05_reject_rows", O.with_model(_S5_SQL + """
SELECT "table", key, reason, COUNT(*) AS copies FROM (
  SELECT 'log_type' AS "table", CAST(id AS VARCHAR) AS key, 'duplicate id' AS reason FROM types_1 WHERE k > 1
  UNION ALL SELECT 'log_type', CAST(id AS VARCHAR), 'duplicate name' FROM types_2 WHERE k2 > 1
  UNION ALL SELECT 'action_type', id, 'duplicate id' FROM actions_1 WHERE k > 1
  UNION ALL SELECT 'action_type', id, 'duplicate name' FROM actions_2 WHERE k2 > 1
  UNION ALL SELECT 'log_entry', coalesce(id, ''), reason FROM entries_1 WHERE reason IS NOT NULL
  UNION ALL SELECT 'log_entry', id, 'duplicate id' FROM entries_2 WHERE k > 1
  UNION ALL SELECT 'log_access_detail', log_entry_id, 'duplicate log_entry_id' FROM details_1 WHERE k > 1
  UNION ALL SELECT 'log_access_detail', log_entry_id, CASE WHEN t IS NULL THEN 'no such log_entry'
    ELSE 'log_entry is not an ACCESS entry' END FROM details_2 WHERE t IS DISTINCT FROM 1) r
GROUP BY ALL"""))
def s05_rejects(spark, sf_dir):
    root, before = _reconciled(spark, sf_dir)
    rows = store.read_rejects(spark, root).select(F.col("kind").alias("table"), "line", "reason", "copies") \
        .unionByName(before.withColumn("copies", F.lit(1).cast("long")))
    key = F.coalesce(F.split("line", ",")[0], F.lit(""))
    return rows.groupBy("table", F.regexp_replace(key, '"', "").alias("key"), "reason") \
        .agg(F.sum("copies").alias("copies"))


@register("s05_reject_accepted", O.with_model(_S5_SQL + """
SELECT e.id, e.log_type_id, e.action_type_id, e.log_timestamp, e.source_ip, e.dest_ip, e.block_id, e.size_bytes,
  d.remote_name, d.auth_user, d.resource, d.http_status, d.referrer, d.user_agent, d.log_entry_id IS NOT NULL AS has_detail
FROM entries_2 e LEFT JOIN (SELECT * FROM details_2 WHERE t = 1) d ON d.log_entry_id = e.id WHERE e.k = 1"""))
def s05_accepted(spark, sf_dir):
    root, _ = _reconciled(spark, sf_dir)
    w = store.read_wide(spark, root)
    return _wall(w.select(*S.ENTRY_FIELDS, *S.DETAIL_VALUE_FIELDS, M.has_detail(w).alias("has_detail")))


@register("s05_reject_details", O.with_model(_S5_SQL + """
SELECT log_entry_id, remote_name, auth_user, resource, http_status, referrer, user_agent FROM details_2 WHERE t = 1"""))
def s05_details(spark, sf_dir):
    return store.read_store(spark, _reconciled(spark, sf_dir)[0]).log_access_detail


@register("s05_dimensions", O.with_model(_S5_SQL + """
SELECT 'log_type' AS "table", CAST(id AS VARCHAR) AS id, name FROM types_2 WHERE k2 = 1
UNION ALL SELECT 'action_type', id, name FROM actions_2 WHERE k2 = 1"""))
def s05_dimensions(spark, sf_dir):
    t = store.read_store(spark, _reconciled(spark, sf_dir)[0])
    return M.union_all([t.log_type.select(F.lit("log_type").alias("table"), F.col("id").cast("string").alias("id"), "name"),
                        t.action_type.select(F.lit("action_type").alias("table"), "id", "name")])


@register("s05_constraints", "SELECT 'no violation' AS found WHERE false")
def s05_constraints(spark, sf_dir):
    """What the reconciling load accepted breaks no constraint (K1-K4)."""
    t = store.read_store(spark, _reconciled(spark, sf_dir)[0])
    return K.summary(t).filter("violations > 0").select(F.col("check").alias("found"))


# --- rollups, merged loads, line counts of the loads -----------------------------------

_EDGES = ("2024-01-04 07:30:00", "2024-01-11 16:45:10")


@register("q01_rollup", O.with_parsed(f"""
SELECT action_name AS action_type_name, CAST(COUNT(*) AS BIGINT) AS logs FROM parsed
WHERE log_timestamp >= {_ts(_EDGES[0])} AND log_timestamp <= {_ts(_EDGES[1])} GROUP BY action_name"""))
def q01_rollup(spark, sf_dir):
    return Q.q01_total_logs_per_action_type(store.read_store(spark, _loaded(spark, sf_dir)), *_EDGES)


@register("q02_rollup", O.with_parsed(f"""
SELECT CAST(log_timestamp AS DATE) AS day, COUNT(*) AS total_logs FROM parsed
WHERE action_name = 'served' AND log_timestamp >= {_ts(_EDGES[0])} AND log_timestamp <= {_ts(_EDGES[1])} GROUP BY ALL"""))
def q02_rollup(spark, sf_dir):
    return Q.q02_logs_per_day_for_action(store.read_store(spark, _loaded(spark, sf_dir)), "served", *_EDGES)


@register("q04_rollup", O.with_parsed(f"""
SELECT block_id, CAST(log_timestamp AS DATE) AS day, COUNT(*) AS total_actions FROM parsed
WHERE block_id IS NOT NULL AND log_timestamp >= DATE '{Q04[0]}' AND log_timestamp < DATE '{Q04[1]}'
GROUP BY ALL ORDER BY total_actions DESC, block_id, day LIMIT 25"""))
def q04_rollup(spark, sf_dir):
    return Q.q04_top_blocks_by_actions_per_day(store.read_store(spark, _loaded(spark, sf_dir)), *Q04[:2], 25)


def _merged(spark, sf_dir) -> str:
    return _once(spark, sf_dir, _merge_two_loads)


def _merge_two_loads(spark, sf_dir) -> str:
    """Two loads, merged, and the second load once more."""
    root = _two_loads(spark, sf_dir)
    store.merge_batches(spark, root)
    store.ingest(spark, default_paths(f"{root}-second"), root, mode="append", batch="second")
    return root


@register("s07_merge", O.with_parsed(f"SELECT {', '.join(_STORE_COLS)} FROM parsed"))
def s07_merge(spark, sf_dir):
    return _wall(store.read_wide(spark, _merged(spark, sf_dir)).select(*_STORE_COLS))


@register("s07_merge_rejects", ORACLE["s09_store_rejects"])
def s07_merge_rejects(spark, sf_dir):
    return store.read_rejects(spark, _merged(spark, sf_dir)).select("kind", "line", "reason")


@register("p10_store_stats", O.with_parsed(f"""
, of_lines AS (SELECT event_id % 2 AS odd, kind, COUNT(*) AS total_lines,
    CAST(SUM(CASE WHEN {O.MATCHED} THEN 1 ELSE 0 END) AS BIGINT) AS matched_lines FROM lines GROUP BY ALL),
  of_rows AS (SELECT event_id % 2 AS odd, CASE log_type_id WHEN 1 THEN 'access' WHEN 2 THEN 'dataxceiver'
    ELSE 'namesystem' END AS kind, COUNT(*) AS rows FROM parsed GROUP BY ALL)
SELECT CASE odd WHEN 0 THEN 'first' ELSE 'second' END AS batch, kind, total_lines, matched_lines, rows
FROM of_lines JOIN of_rows USING (odd, kind)""".replace("\n, of_lines", ", of_lines", 1)))
def p10_store_stats(spark, sf_dir):
    return store.read_stats(spark, _merged(spark, sf_dir))


# --- catalog -----------------------------------------------------------------------

_CALLS = {1: dict(start=Q01[0], end=Q01[1]), 2: dict(action_name=Q02[0], start=Q02[1], end=Q02[2]),
          3: dict(day=Q03), 4: dict(start_day=Q04[0], end_day=Q04[1]), 5: {}, 6: {}, 7: dict(max_size=Q07),
          8: {}, 9: {}, 10: dict(version=Q10), 11: dict(method=Q11[1], start=Q11[2], end=Q11[3]),
          12: dict(method1=Q12[1], method2=Q12[2], start=Q12[3], end=Q12[4]),
          13: dict(start=Q13[2], end=Q13[3])}


# --- entry and detail in the same buckets ---------------------------------------------

def _write_buckets(spark, sf_dir) -> str:
    root = scratch_path(spark, "buckets")
    bucketed.write_tables(_separate(spark, sf_dir), root, buckets=4)
    return root


@register("j03_q07_buckets", ORACLE["q07_access_logs_below_size"])
def j03_q07_buckets(spark, sf_dir):
    return Q.q07_access_logs_below_size(bucketed.open_tables(spark, _once(spark, sf_dir, _write_buckets)), Q07)


@register("j03_q10_buckets", ORACLE["q10_access_logs_by_user_agent_version"])
def j03_q10_buckets(spark, sf_dir):
    return Q.q10_access_logs_by_user_agent_version(
        bucketed.open_tables(spark, _once(spark, sf_dir, _write_buckets)), Q10)


# --- the catalog as SQL table functions ------------------------------------------------

_SQL_ARGS = {1: Q01, 2: Q02, 3: (Q03,), 4: Q04, 5: (), 6: (), 7: (Q07,), 8: (), 9: (), 10: (Q10,), 11: Q11, 12: Q12, 13: Q13}


def _sql_key(number: int, key: str):
    @register(f"sql_{key}", ORACLE[key])
    def fn(spark, sf_dir):
        SF.register(spark, fixture_tables(spark, sf_dir), prefix="events_")
        return SF.call(spark, number, *_SQL_ARGS[number], prefix="events_")
    fn.__name__ = f"sql_{key}"


for _n in _SQL_ARGS:
    _sql_key(_n, next(k for k in ORACLE if k.startswith(f"q{_n:02d}_")))


def _row_text(df: DataFrame) -> DataFrame:
    """Every row as one text: ``name=value`` of its columns, NULL as an empty value."""
    kinds = dict(df.dtypes)
    cols = []
    for c in sorted(df.columns):
        v = F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kinds[c].startswith("timestamp") else F.col(c).cast("string")
        cols.append(F.concat(F.lit(f"{c}="), F.coalesce(v, F.lit(""))))
    return df.select(F.concat_ws(";", *cols).alias("row"))


#: Columns of each entry's result, by name; the time columns among them.
_RESULT_COLS = {1: "action_type_name logs", 2: "day total_logs", 3: "action_type_name frequency source_ip",
                4: "block_id day total_actions", 5: "referrer resource_frequency", 6: "frequency resource",
                7: " ".join(sorted(Q.RESULT_14)), 8: "block_id", 9: "block_id", 10: " ".join(sorted(Q.RESULT_14)),
                11: "source_ip", 12: "source_ip", 13: "cnt methods source_ip"}


def _text_sql(entry: int) -> str:
    value = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c == "log_timestamp" else f"CAST({c} AS VARCHAR)"
    cols = " || ';' || ".join(f"'{c}=' || coalesce({value(c)}, '')" for c in _RESULT_COLS[entry].split())
    sql = next(v for q, v in ORACLE.items() if q.startswith(f"q{entry:02d}_"))
    return f"SELECT {entry} AS entry, {cols} AS row FROM ({sql}) r{entry}"


@register("c02_run_all", " UNION ALL ".join(_text_sql(k) for k in _CALLS))
def c02(spark, sf_dir):
    """Every row of every entry, run by its number with named parameters."""
    t = fixture_tables(spark, sf_dir)
    return M.union_all(_row_text(C.run(t, k, p)).select(F.lit(k).alias("entry"), "row") for k, p in _CALLS.items())


@register("c02_run_metrics", " UNION ALL ".join(
    f"SELECT {k} AS entry, COUNT(*) AS row_count, COUNT(*) AS rows_read, true AS timed FROM ({_text_sql(k)}) m{k}"
    for k in _CALLS))
def c02_metrics(spark, sf_dir):
    """Row counts observed while the entries ran, beside the rows then read, and that a time was taken."""
    t = fixture_tables(spark, sf_dir)
    out = []
    for k, p in _CALLS.items():
        rows = C.run_rows(t, k, p)
        out.append((k, rows.row_count, sum(1 for _ in rows), rows.elapsed_ms > 0))
    return spark.createDataFrame(out, "entry int, row_count long, rows_read long, timed boolean")


_AUDIT_SQL = """
SELECT event_id AS id, user_id, event_type AS query_text, CAST(user_id AS VARCHAR) || ', ' || event_type AS params,
  ts AS executed_at FROM events
UNION ALL SELECT -1, 7, 'q02_logs_per_day_for_action', 'GET, 2024-01-02 00:00:00, 2024-01-12 00:00:00', NULL
UNION ALL SELECT -1, 7, 'q15_audit_listing', '', NULL"""


@register("q15_audit_listing", _AUDIT_SQL)
def q15(spark, sf_dir):
    """Calls of before (one per event), a call of Q2, and the listing, which sees its own row.

    The two calls' ids and times are those of this run: they are checked to come first, in the
    order of the calls, and are then shown as -1 and NULL."""
    path = scratch_path(spark, "audit")
    read_events(spark, sf_dir).select(
        F.col("event_id").alias("id"), "user_id", F.col("event_type").alias("query_text"),
        F.concat_ws(", ", F.col("user_id").cast("string"), "event_type").alias("params"),
        F.col("ts").cast("timestamp").alias("executed_at")).write.parquet(path)
    t, audit = fixture_tables(spark, sf_dir), C.AuditLog(spark, path)
    C.run(t, 2, _CALLS[2], user_id=7, audit=audit)
    rows = C.run(t, 15, user_id=7, audit=audit)
    newest = [r["query_text"] for r in rows.limit(2).collect()]
    own = F.col("query_text").isin("q15_audit_listing", "q02_logs_per_day_for_action") \
        & F.lit(newest == ["q15_audit_listing", "q02_logs_per_day_for_action"])
    return rows.select(F.when(own, -1).otherwise(F.col("id")).cast("long").alias("id"), "user_id", "query_text", "params",
                       F.when(~own, as_wall_clock(F.col("executed_at"))).alias("executed_at"))


# --- streaming: every file once, a replayed stream adds nothing ---------------------

@register("st01_stream_parse", O.with_parsed(f"SELECT {', '.join(_STORE_COLS)} FROM parsed"))
def st01(spark, sf_dir):
    from ..streaming.ingest import run_to_store
    root = scratch_path(spark, "stream")
    paths = _text_files(spark, sf_dir, f"{root}-text", fixture_lines(spark, sf_dir))
    for checkpoint in ("a", "b"):  # a lost checkpoint replays the first epoch
        run_to_store(spark, paths, root, f"{root}-{checkpoint}", available_now=True).awaitTermination()
    return _wall(store.read_wide(spark, root).select(*_STORE_COLS))
