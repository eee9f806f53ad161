"""ANSI SQL (DuckDB dialect) twins of the fixture derivations.

Used as the independent oracle for the Spark queries: the same projection
of ``events`` and the same raw lines are built in SQL, then parsed with
DuckDB's RE2 ``regexp_extract`` (group index <= 9, hence the access pattern
is split in two). Nothing here runs in Spark.
"""

from __future__ import annotations

# --- fixed values: model rows, line shapes and RE2 line patterns -----------------
# Four-table projection of ``events`` (log_type_id typed SMALLINT as in Spark).
MODEL_CTE = r"""
log_type(id, name) AS (VALUES (CAST(1 AS SMALLINT),'ACCESS'),(CAST(2 AS SMALLINT),'HDFS_DATAXCEIVER'),(CAST(3 AS SMALLINT),'HDFS_NAMESYSTEM')),
action_type(id, name) AS (VALUES ('1534bc02-65e4-529a-bfe0-d9b9ab110a4e','GET'),('63586aa1-858b-516f-895d-5d9af98d7a7a','POST'),('cf2ea338-ada2-5c38-8ddc-de35e79a6d5e','PUT'),('412afff4-d8a9-5111-be1b-8a7d79bb08fe','HEAD'),('78b798e6-ce05-5b4b-b003-362ab5b18c6a','DELETE'),('83d2a8c1-4a0a-5c15-be61-4a57ebaee591','receiving'),('d68f1e98-3606-50b9-8cba-71f77b8657e4','received'),('0b802f68-b723-5561-9dd1-b6e86a401ed0','served'),('d68041c8-cb8b-5167-bc26-8b1eb6f89ec2','update'),('fd33d5d0-a2fe-5b56-89b8-e25f5aca3238','replicate')),
raw AS (SELECT event_id, ts, user_id, value, CASE WHEN event_id % 2 = 0
   THEN CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'POST' WHEN 'purchase' THEN 'PUT' WHEN 'signup' THEN 'HEAD' ELSE 'DELETE' END
   ELSE CASE event_type WHEN 'view' THEN 'receiving' WHEN 'click' THEN 'received' WHEN 'purchase' THEN 'served' WHEN 'signup' THEN 'update' ELSE 'replicate' END END AS action_name FROM events),
log_entry AS (SELECT concat('e', CAST(r.event_id AS VARCHAR)) AS id,
   CAST(CASE WHEN r.event_id % 2 = 0 THEN 1 WHEN r.action_name IN ('update','replicate') THEN 3 ELSE 2 END AS SMALLINT) AS log_type_id,
   a.id AS action_type_id, r.ts AS log_timestamp,
   concat('10.0.', CAST(CAST(FLOOR(r.user_id / 250) AS INT) AS VARCHAR), '.', CAST(r.user_id % 250 AS VARCHAR)) AS source_ip,
   CASE WHEN r.event_id % 2 = 1 THEN '10.1.0.1' END AS dest_ip,
   CASE WHEN r.event_id % 2 = 1 THEN r.user_id END AS block_id,
   CASE WHEN r.event_id % 10 <> 0 THEN CAST(FLOOR(r.value) AS BIGINT) END AS size_bytes
   FROM raw r JOIN action_type a ON a.name = r.action_name),
log_access_detail AS (SELECT concat('e', CAST(event_id AS VARCHAR)) AS log_entry_id, '-' AS remote_name, '-' AS auth_user,
   concat('/r/', CAST(user_id % 37 AS VARCHAR)) AS resource, 200 AS http_status,
   CASE WHEN user_id % 5 <> 0 THEN concat('http://ref/', CAST(user_id % 11 AS VARCHAR)) END AS referrer,
   concat('Mozilla/', CAST(4 + user_id % 3 AS VARCHAR), '.0 (X11)') AS user_agent FROM raw WHERE event_id % 2 = 0)
"""

ENTRY_DETAIL_COLS = ("le.id, le.log_type_id, le.action_type_id, le.log_timestamp, le.source_ip, "
                     "le.dest_ip, le.block_id, le.size_bytes, lad.remote_name, lad.auth_user, "
                     "lad.resource, lad.http_status, lad.referrer, lad.user_agent")

# Raw lines, one per event, seven shapes by event_id % 7.
LINES_CTE = r"""
lines AS (SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN 'access' WHEN event_id % 7 IN (4, 5) THEN 'namesystem' ELSE 'dataxceiver' END AS kind,
  CASE event_id % 7
  WHEN 0 THEN concat('10.0.0.', CAST(user_id % 250 AS VARCHAR), ' - - [', strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' +0300] "',
       CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'POST' ELSE 'HEAD' END,
       ' /r/', CAST(user_id % 37 AS VARCHAR), ' HTTP/1.1" 200 ',
       CASE WHEN event_id % 2 = 0 THEN '-' ELSE CAST(CAST(FLOOR(value) AS BIGINT) AS VARCHAR) END,
       ' "', CASE WHEN user_id % 5 = 0 THEN '-' ELSE 'http://ref/' END, '" "Mozilla/5.0 (X11)"')
  WHEN 1 THEN concat(strftime(ts, '%y%m%d %H%M%S'), ' 13 INFO dfs.DataNode$DataXceiver: Receiving block blk_-', CAST(user_id AS VARCHAR), ' src: /10.1.0.1:50010 dest: /10.1.0.2:50010')
  WHEN 2 THEN concat(strftime(ts, '%y%m%d %H%M%S'), ' 13 INFO dfs.DataNode$DataXceiver: Received block blk_', CAST(user_id AS VARCHAR), ' src: /10.1.0.1:50010 dest: /10.1.0.2:50010', CASE WHEN event_id % 2 = 0 THEN concat(' of size ', CAST(event_id AS VARCHAR)) ELSE '' END)
  WHEN 3 THEN concat(strftime(ts, '%y%m%d %H%M%S'), ' 13 INFO dfs.DataNode$DataXceiver: 10.1.0.3:50010 Served block blk_', CAST(user_id AS VARCHAR), ' to /10.1.0.4')
  WHEN 4 THEN concat(strftime(ts, '%y%m%d %H%M%S'), ' 26 INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blockMap updated: 10.1.0.5:50010 is added to blk_', CAST(user_id AS VARCHAR), CASE WHEN event_id % 2 = 0 THEN concat(' size ', CAST(event_id AS VARCHAR)) ELSE '' END)
  WHEN 5 THEN concat(strftime(ts, '%y%m%d %H%M%S'), ' 26 INFO dfs.FSNamesystem: BLOCK* ask 10.1.0.6:50010 to replicate blk_', CAST(user_id AS VARCHAR), ' to datanode(s) 10.1.0.7:50010', CASE WHEN event_id % 2 = 0 THEN ' 10.1.0.8:50010' ELSE '' END)
  ELSE concat(strftime(ts, '%y%m%d %H%M%S'), ' 13 WARN dfs.DataNode$DataXceiver: junk') END AS line
FROM events)
"""

# RE2 forms of the line patterns (no inline flags; at most 9 groups each).
H = r"^(\d{6})\s+(\d{6})\s+\d+\s+INFO\s+"
P_ACCESS = (r'^(\S+)\s+(\S+)\s+(\S+)\s+\[([^\]]+)\]\s+"([A-Za-z]+)\s+([^"]+?)\s+HTTP/[^"]+"\s+'
            r'(\d{3})\s+(\S+)\s+"([^"]*)"\s+"[^"]*"')
P_AGENT = (r'^\S+\s+\S+\s+\S+\s+\[[^\]]+\]\s+"[A-Za-z]+\s+[^"]+?\s+HTTP/[^"]+"\s+\d{3}\s+\S+\s+'
           r'"[^"]*"\s+"([^"]*)"')
P_RECEIVING = H + (r"dfs\.DataNode\$DataXceiver:\s+Receiving\s+block\s+(blk_[0-9\-]+)\s+src:\s+"
                   r"/([0-9.]+):\d+\s+dest:\s+/([0-9.]+):\d+$")
P_RECEIVED = H + (r"dfs\.DataNode\$DataXceiver:\s+Received\s+block\s+(blk_[0-9\-]+).*?src:\s+"
                  r"/([0-9.]+):\d+\s+dest:\s+/([0-9.]+):\d+(?:.*?size\s+(\d+))?$")
P_SERVED = H + (r"dfs\.DataNode\$DataXceiver:\s+([0-9.]+):\d+\s+Served\s+block\s+"
                r"(blk_[0-9\-]+)\s+to\s+/([0-9.]+)$")
P_UPDATE = H + (r"dfs\.FSNamesystem:\s+BLOCK\*\s+NameSystem\.\w+:\s+blockMap\s+updated:\s+"
                r"([0-9.]+):\d+.*?blk_(-?\d+)(?:\s+size\s+(\d+))?$")
P_REPLICATE = H + (r"dfs\.FSNamesystem:\s+BLOCK\*\s+ask\s+([0-9.]+):\d+\s+to\s+replicate\s+"
                   r"blk_(-?\d+)\s+to\s+datanode\(s\)\s+((?:[0-9.]+:\d+\s*)+)$")


def _hdfs_ts(d: str, t: str) -> str:
    return (f"try_strptime(concat(CASE WHEN substr({d},1,2) >= '69' THEN '19' ELSE '20' END, {d}, {t}),"
            " '%Y%m%d%H%M%S')")


def _x(p: str, g: int) -> str:
    return f"regexp_extract(line, '{p}', {g})"


ACCESS_TS = ("(try_strptime(substr({s},1,20), '%d/%b/%Y:%H:%M:%S') - to_minutes(CAST("
             "(CASE WHEN substr({s},22,1) = '-' THEN -1 ELSE 1 END) * "
             "(TRY_CAST(substr({s},23,2) AS INT) * 60 + TRY_CAST(substr({s},25,2) AS INT)) AS BIGINT)))")

# One SELECT per line shape; the columns are those of the Spark parse.
PARSED_ACCESS = f"""
SELECT event_id, CAST(1 AS SMALLINT) AS log_type_id, {_x(P_ACCESS, 5)} AS action_name,
  {ACCESS_TS.format(s=_x(P_ACCESS, 4))} AS log_timestamp,
  nullif({_x(P_ACCESS, 1)}, '') AS source_ip, CAST(NULL AS VARCHAR) AS dest_ip,
  CAST(NULL AS BIGINT) AS block_id,
  TRY_CAST(nullif(nullif({_x(P_ACCESS, 8)}, '-'), '') AS BIGINT) AS size_bytes,
  nullif({_x(P_ACCESS, 2)}, '') AS remote_name, nullif({_x(P_ACCESS, 3)}, '') AS auth_user,
  nullif({_x(P_ACCESS, 6)}, '') AS resource, TRY_CAST({_x(P_ACCESS, 7)} AS INT) AS http_status,
  nullif(nullif({_x(P_ACCESS, 9)}, '-'), '') AS referrer, nullif({_x(P_AGENT, 1)}, '') AS user_agent
FROM lines WHERE kind = 'access' AND regexp_matches(line, '{P_ACCESS}')"""

_HDFS_TAIL = ("CAST(NULL AS VARCHAR) AS remote_name, CAST(NULL AS VARCHAR) AS auth_user, "
              "CAST(NULL AS VARCHAR) AS resource, CAST(NULL AS INT) AS http_status, "
              "CAST(NULL AS VARCHAR) AS referrer, CAST(NULL AS VARCHAR) AS user_agent")

PARSED_RECEIVING = f"""
SELECT event_id, CAST(2 AS SMALLINT) AS log_type_id, 'receiving' AS action_name,
  {_hdfs_ts(_x(P_RECEIVING, 1), _x(P_RECEIVING, 2))} AS log_timestamp,
  {_x(P_RECEIVING, 4)} AS source_ip, {_x(P_RECEIVING, 5)} AS dest_ip,
  TRY_CAST(replace({_x(P_RECEIVING, 3)}, 'blk_', '') AS BIGINT) AS block_id,
  CAST(NULL AS BIGINT) AS size_bytes, {_HDFS_TAIL}
FROM lines WHERE kind = 'dataxceiver' AND regexp_matches(line, '{P_RECEIVING}')"""

PARSED_RECEIVED = f"""
SELECT event_id, CAST(2 AS SMALLINT) AS log_type_id, 'received' AS action_name,
  {_hdfs_ts(_x(P_RECEIVED, 1), _x(P_RECEIVED, 2))} AS log_timestamp,
  {_x(P_RECEIVED, 4)} AS source_ip, {_x(P_RECEIVED, 5)} AS dest_ip,
  TRY_CAST(replace({_x(P_RECEIVED, 3)}, 'blk_', '') AS BIGINT) AS block_id,
  TRY_CAST(nullif({_x(P_RECEIVED, 6)}, '') AS BIGINT) AS size_bytes, {_HDFS_TAIL}
FROM lines WHERE kind = 'dataxceiver' AND NOT regexp_matches(line, '{P_RECEIVING}')
  AND regexp_matches(line, '{P_RECEIVED}')"""

PARSED_SERVED = f"""
SELECT event_id, CAST(2 AS SMALLINT) AS log_type_id, 'served' AS action_name,
  {_hdfs_ts(_x(P_SERVED, 1), _x(P_SERVED, 2))} AS log_timestamp,
  {_x(P_SERVED, 3)} AS source_ip, {_x(P_SERVED, 5)} AS dest_ip,
  TRY_CAST(replace({_x(P_SERVED, 4)}, 'blk_', '') AS BIGINT) AS block_id,
  CAST(NULL AS BIGINT) AS size_bytes, {_HDFS_TAIL}
FROM lines WHERE kind = 'dataxceiver' AND NOT regexp_matches(line, '{P_RECEIVING}')
  AND NOT regexp_matches(line, '{P_RECEIVED}') AND regexp_matches(line, '{P_SERVED}')"""

PARSED_UPDATE = f"""
SELECT event_id, CAST(3 AS SMALLINT) AS log_type_id, 'update' AS action_name,
  {_hdfs_ts(_x(P_UPDATE, 1), _x(P_UPDATE, 2))} AS log_timestamp,
  {_x(P_UPDATE, 3)} AS source_ip, CAST(NULL AS VARCHAR) AS dest_ip,
  TRY_CAST({_x(P_UPDATE, 4)} AS BIGINT) AS block_id,
  TRY_CAST(nullif({_x(P_UPDATE, 5)}, '') AS BIGINT) AS size_bytes, {_HDFS_TAIL}
FROM lines WHERE kind = 'namesystem' AND regexp_matches(line, '{P_UPDATE}')"""

PARSED_REPLICATE = rf"""
SELECT event_id, CAST(3 AS SMALLINT) AS log_type_id, 'replicate' AS action_name, log_timestamp,
  source_ip, split_part(tok, ':', 1) AS dest_ip, block_id, CAST(NULL AS BIGINT) AS size_bytes, {_HDFS_TAIL}
FROM (SELECT event_id, {_hdfs_ts(_x(P_REPLICATE, 1), _x(P_REPLICATE, 2))} AS log_timestamp,
        {_x(P_REPLICATE, 3)} AS source_ip, TRY_CAST({_x(P_REPLICATE, 4)} AS BIGINT) AS block_id,
        unnest(string_split_regex({_x(P_REPLICATE, 5)}, '\s+')) AS tok
      FROM lines WHERE kind = 'namesystem' AND NOT regexp_matches(line, '{P_UPDATE}')
        AND regexp_matches(line, '{P_REPLICATE}')) r
WHERE tok LIKE '%:%'"""

MATCHED = (f"CASE kind WHEN 'access' THEN regexp_matches(line, '{P_ACCESS}') "
           f"WHEN 'dataxceiver' THEN regexp_matches(line, '{P_RECEIVING}') OR "
           f"regexp_matches(line, '{P_RECEIVED}') OR regexp_matches(line, '{P_SERVED}') "
           f"ELSE regexp_matches(line, '{P_UPDATE}') OR regexp_matches(line, '{P_REPLICATE}') END")

PARSED_ALL = " UNION ALL ".join([PARSED_ACCESS, PARSED_RECEIVING, PARSED_RECEIVED, PARSED_SERVED,
                                 PARSED_UPDATE, PARSED_REPLICATE])


def uuid5_sql(name: str) -> str:
    """DuckDB expression: version-5 UUID of ``name`` (fixed namespace)."""
    h = f"sha1(unhex('12345678123456781234567812345678') || encode({name}))"
    return (f"(SELECT concat_ws('-', substr(h,1,8), substr(h,9,4), '5' || substr(h,14,3), "
            f"substr('89ab', ((position(substr(h,17,1) IN '0123456789abcdef') - 1) & 3) + 1, 1) "
            f"|| substr(h,18,3), substr(h,21,12)) FROM (SELECT {h} AS h))")


def with_model(body: str) -> str:
    return "WITH " + MODEL_CTE.strip() + "\n" + body


def with_lines(body: str) -> str:
    return "WITH " + LINES_CTE.strip() + "\n" + body


def with_parsed(body: str) -> str:
    return ("WITH " + LINES_CTE.strip() + ",\nparsed AS (" + PARSED_ALL + ")\n" + body)
