"""Text line -> typed log rows (P1-P11), as distributed column transforms.

Every log kind is a list of alternatives tried in order; the first one
that matches a line wins. A line is classified with at most one regex
evaluation per alternative tried (see :func:`regex_groups`) and a cheap
``contains`` guard skips alternatives whose keyword is absent. The typed
columns are then derived from the captures with built-in functions only.

Lines that match nothing, or match but carry a value that does not convert
(bad stamp, ``blk_1-2``, an address that is not an IP), are not dropped
silently: they come back as a reject DataFrame ``(line, reason)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import regex_groups
from ..functions.timestamps import access_timestamp, hdfs_timestamp
from ..functions.values import (block_value, dash_to_null, empty_to_null, host_part,
                                int_value, is_ip, size_value)

# --- fixed values: line patterns -------------------------------------------
# Java regex; (?d) makes only '\n' a line terminator, as in Python.
HDFS_HEAD = r"(?d)^(\d{6})\s+(\d{6})\s+\d+\s+INFO\s+"
ACCESS_LINE = (r'(?d)^(\S+)\s+(\S+)\s+(\S+)\s+\[([^\]]+)\]\s+'
               r'"([A-Za-z]+)\s+([^"]+?)\s+HTTP/[^"]+"\s+'
               r'(\d{3})\s+(\S+)\s+"([^"]*)"\s+"([^"]*)"')
RECEIVING_LINE = HDFS_HEAD + (r"dfs\.DataNode\$DataXceiver:\s+Receiving\s+block\s+"
                              r"(blk_[0-9\-]+)\s+src:\s+/([0-9.]+):\d+\s+dest:\s+/([0-9.]+):\d+$")
RECEIVED_LINE = HDFS_HEAD + (r"dfs\.DataNode\$DataXceiver:\s+Received\s+block\s+"
                             r"(blk_[0-9\-]+).*?src:\s+/([0-9.]+):\d+\s+dest:\s+/([0-9.]+):\d+"
                             r"(?:.*?size\s+(\d+))?$")
SERVED_LINE = HDFS_HEAD + (r"dfs\.DataNode\$DataXceiver:\s+([0-9.]+):\d+\s+Served\s+block\s+"
                           r"(blk_[0-9\-]+)\s+to\s+/([0-9.]+)$")
UPDATE_LINE = HDFS_HEAD + (r"dfs\.FSNamesystem:\s+BLOCK\*\s+NameSystem\.\w+:\s+"
                           r"blockMap\s+updated:\s+([0-9.]+):\d+.*?blk_(-?\d+)(?:\s+size\s+(\d+))?$")
REPLICATE_LINE = HDFS_HEAD + (r"dfs\.FSNamesystem:\s+BLOCK\*\s+ask\s+([0-9.]+):\d+\s+to\s+"
                              r"replicate\s+blk_(-?\d+)\s+to\s+datanode\(s\)\s+"
                              r"((?:[0-9.]+:\d+\s*)+)$")
# Older access format: single spaces, any method/resource/protocol token.
ACCESS_LINE_ARCHIVED = (r'(?d)^(\S+) (\S+) (\S+) \[(.+?)\] "(\S+) (\S+) \S+" '
                        r'(\d{3}) (\S+) "(.*?)" "(.*?)"')
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Alternative:
    """One line shape: action name, pattern, group count, keyword guard and
    the positions (0-based) of each field among the captures."""
    action: str | None          # None: the action is a capture (access method)
    pattern: str
    n_groups: int
    guard: str                  # literal every matching line contains
    fields: dict                # field name -> capture index


# Field names used in ``Alternative.fields``.
ACCESS_ALT = Alternative(None, ACCESS_LINE, 10, '"', dict(
    source=0, remote_name=1, auth_user=2, stamp=3, action=4, resource=5,
    status=6, size=7, referrer=8, agent=9))
ACCESS_ALT_ARCHIVED = Alternative(None, ACCESS_LINE_ARCHIVED, 10, '"', dict(
    source=0, remote_name=1, auth_user=2, stamp=3, action=4, resource=5,
    status=6, size=7, referrer=8, agent=9))
RECEIVING_ALT = Alternative("receiving", RECEIVING_LINE, 5, "Receiving", dict(
    date=0, time=1, block=2, source=3, dest=4))
RECEIVED_ALT = Alternative("received", RECEIVED_LINE, 6, "Received", dict(
    date=0, time=1, block=2, source=3, dest=4, size=5))
SERVED_ALT = Alternative("served", SERVED_LINE, 5, "Served", dict(
    date=0, time=1, source=2, block=3, dest=4))
UPDATE_ALT = Alternative("update", UPDATE_LINE, 5, "blockMap", dict(
    date=0, time=1, source=2, block=3, size=4))
REPLICATE_ALT = Alternative("replicate", REPLICATE_LINE, 5, "replicate", dict(
    date=0, time=1, source=2, block=3, dest_list=4))


@dataclass(frozen=True)
class LogKind:
    name: str
    log_type_id: int
    alternatives: tuple
    access: bool = False


# Registry: adding a log kind = a new entry (patterns + field positions).
KINDS = {
    "access": LogKind("access", S.ACCESS, (ACCESS_ALT,), access=True),
    "dataxceiver": LogKind("dataxceiver", S.HDFS_DATAXCEIVER,
                           (RECEIVING_ALT, RECEIVED_ALT, SERVED_ALT)),
    "namesystem": LogKind("namesystem", S.HDFS_NAMESYSTEM, (UPDATE_ALT, REPLICATE_ALT)),
}
#: All kinds at once, for lines that name theirs; the kind of each alternative beside it.
ROUTED = LogKind("routed", 0, tuple(a for k in KINDS.values() for a in k.alternatives))
ROUTES = tuple(name for name, k in KINDS.items() for _ in k.alternatives)
ARCHIVED_ACCESS = LogKind("access", S.ACCESS, (ACCESS_ALT_ARCHIVED,), access=True)


NO_MATCH = "no match"


@dataclass
class Parsed:
    """Typed rows (``schema.PARSED`` columns + passthrough) and rejects."""
    rows: DataFrame
    rejects: DataFrame


def classify(lines: DataFrame, kind: LogKind, line_col: str = "value", kind_col: str | None = None) -> DataFrame:
    """One row per line with ``_g`` (captures of the winning alternative with
    its index appended) and ``_alt`` (that index, NULL when nothing matched).

    The alternatives form one ``coalesce``, which evaluates an alternative
    only when all earlier ones failed (and only if its keyword is present).
    The result passes through a one-element ``explode`` - a Generate node -
    so later projections read the captures instead of re-running the regex
    once per derived column. With ``kind_col`` (kind ``ROUTED``) a line tries only the
    alternatives of the kind it names."""
    line = F.col(line_col)
    attempts = []
    for i, alt in enumerate(kind.alternatives):
        guard = line.contains(alt.guard)
        if kind_col is not None:
            guard = (F.col(kind_col) == ROUTES[i]) & guard
        groups = F.when(guard, regex_groups(line, alt.pattern, alt.n_groups))
        attempts.append(F.concat(groups, F.array(F.lit(str(i)))))
    first = attempts[0] if len(attempts) == 1 else F.coalesce(*attempts)
    out = lines.select("*", F.explode(F.array(first)).alias("_g"))
    return out.withColumn("_alt", F.element_at(F.col("_g"), -1).cast("int"))


def _field(kind: LogKind, field: str) -> Column:
    """Capture text of ``field`` for the winning alternative, else NULL."""
    places = [(i, a.fields[field]) for i, a in enumerate(kind.alternatives) if field in a.fields]
    captures = F.col("_g")
    if not places:
        return F.lit(None).cast("string")
    if len(kind.alternatives) == 1:  # captures are NULL where it did not match
        return captures[places[0][1]]
    out = F.when(F.col("_alt") == places[0][0], captures[places[0][1]])
    for i, pos in places[1:]:
        out = out.when(F.col("_alt") == i, captures[pos])
    return out


def _action(kind: LogKind) -> Column:
    out = F.lit(None).cast("string")
    for i in reversed(range(len(kind.alternatives))):
        alt = kind.alternatives[i]
        val = F.lit(alt.action) if alt.action else F.col("_g")[alt.fields["action"]]
        out = F.when(F.col("_alt") == i, val).otherwise(out)
    return out


def _typed(classified: DataFrame, kind: LogKind, keep: Sequence[str], line_col: str,
           validate_ips: bool, kind_col: str | None = None) -> DataFrame:
    """Typed columns, ``first_of_line`` (a line's first row) and ``reject_reason`` (NULL for good rows)."""
    has_list = any("dest_list" in a.fields for a in kind.alternatives)
    df = classified
    first = F.lit(True)
    if has_list:
        # One row per destination of a replicate line (P6); other lines keep
        # one row through a single NULL element.
        tokens = F.filter(F.split(_field(kind, "dest_list"), r"\s+"), lambda t: t.contains(":"))
        df = df.select("*", F.posexplode(
            F.when(_field(kind, "dest_list").isNotNull(), tokens)
             .otherwise(F.array(F.lit(None).cast("string")))).alias("_place", "_dest_tok"))
        first = F.col("_place") == 0
        dest = F.coalesce(F.when(F.col("_dest_tok").isNotNull(), host_part(F.col("_dest_tok"))),
                          empty_to_null(_field(kind, "dest")))
    else:
        dest = empty_to_null(_field(kind, "dest"))

    type_id = F.lit(kind.log_type_id)
    if kind_col is not None:
        route = F.col(kind_col)
        type_id = F.coalesce(*[F.when(route == name, F.lit(k.log_type_id)) for name, k in KINDS.items()])
        stamp = F.when(route.isin([name for name, k in KINDS.items() if k.access]), access_timestamp(_field(kind, "stamp"))) \
                 .otherwise(hdfs_timestamp(_field(kind, "date"), _field(kind, "time")))
    elif kind.access:
        stamp = access_timestamp(_field(kind, "stamp"))
    else:
        stamp = hdfs_timestamp(_field(kind, "date"), _field(kind, "time"))
    size_raw = dash_to_null(_field(kind, "size"))
    block_raw = empty_to_null(_field(kind, "block"))
    source = empty_to_null(_field(kind, "source"))

    cols = {
        "log_type_id": type_id.cast("short"),
        "action_name": _action(kind),
        "log_timestamp": stamp,
        "source_ip": source,
        "dest_ip": dest,
        "block_id": block_value(block_raw),
        "size_bytes": size_value(size_raw),
        "remote_name": empty_to_null(_field(kind, "remote_name")),
        "auth_user": empty_to_null(_field(kind, "auth_user")),
        "resource": empty_to_null(_field(kind, "resource")),
        "http_status": int_value(_field(kind, "status")),
        "referrer": dash_to_null(_field(kind, "referrer")),
        "user_agent": empty_to_null(_field(kind, "agent")),
    }
    df = df.select(*keep, F.col(line_col).alias("_line"), "_alt", first.alias("first_of_line"),
                   *[c.alias(n) for n, c in cols.items()],
                   size_raw.alias("_size_raw"), block_raw.alias("_block_raw"))
    reason = (F.when(F.col("_alt").isNull(), NO_MATCH)
               .when(F.col("log_timestamp").isNull(), "bad timestamp")
               .when(F.col("_block_raw").isNotNull() & F.col("block_id").isNull(), "bad block id")
               .when(F.col("_size_raw").isNotNull() & F.col("size_bytes").isNull(), "bad size"))
    if validate_ips:
        reason = (reason.when(F.col("source_ip").isNotNull() & ~is_ip(F.col("source_ip")),
                              "bad source ip")
                        .when(F.col("dest_ip").isNotNull() & ~is_ip(F.col("dest_ip")),
                              "bad dest ip"))
    # The raw text is kept only where it is needed: on rejected rows.
    return (df.withColumn("reject_reason", reason)
              .withColumn("_line", F.when(F.col("reject_reason").isNotNull(), F.col("_line")))
              .drop("_size_raw", "_block_raw", "_alt"))


def parse_typed(lines: DataFrame, kind: str | LogKind, line_col: str = "value",
                keep: Sequence[str] = (), validate_ips: bool = True) -> DataFrame:
    """All parsed rows with a ``reject_reason`` column and the ``_line`` text;
    the form to materialize once before splitting rows from rejects."""
    k = KINDS[kind] if isinstance(kind, str) else kind
    return _typed(classify(lines, k, line_col), k, list(keep), line_col, validate_ips)


def parse_routed(lines: DataFrame, kind_col: str = "kind", line_col: str = "value",
                 keep: Sequence[str] = (), validate_ips: bool = True) -> DataFrame:
    """As :func:`parse_typed`, for lines of all kinds in one pass: ``kind_col`` names each line's kind."""
    classified = classify(lines, ROUTED, line_col, kind_col)
    return _typed(classified, ROUTED, list(dict.fromkeys([*keep, kind_col])), line_col, validate_ips, kind_col)


def accepted(typed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return (typed.filter(F.col("reject_reason").isNull())
                 .select(*keep, *S.PARSED_FIELDS))


def rejected(typed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return (typed.filter(F.col("reject_reason").isNotNull())
                 .select(*keep, F.col("_line").alias("line"), F.col("reject_reason").alias("reason")))


def parse_lines(lines: DataFrame, kind: str | LogKind, line_col: str = "value",
                keep: Sequence[str] = (), validate_ips: bool = True) -> Parsed:
    """Parse one log kind. ``keep`` columns pass through (file, ids)."""
    typed = parse_typed(lines, kind, line_col, keep, validate_ips)
    return Parsed(accepted(typed, keep), rejected(typed, keep))


def match_stats(lines: DataFrame, kind: str | LogKind, line_col: str = "value",
                by: Sequence[str] = ("file",)) -> DataFrame:
    """P10: matched / total lines per group (lines, not rows: a replicate line
    with two destinations counts once). Partial aggregation, one small shuffle."""
    k = KINDS[kind] if isinstance(kind, str) else kind
    c = classify(lines.select(*by, line_col), k, line_col)
    return (c.groupBy(*by)
             .agg(F.count(F.lit(1)).alias("total_lines"),
                  F.count(F.col("_alt")).alias("matched_lines")))


def rows_per_type(rows: DataFrame) -> DataFrame:
    """Parsed rows per log type."""
    return rows.groupBy("log_type_id").agg(F.count(F.lit(1)).alias("rows"))
