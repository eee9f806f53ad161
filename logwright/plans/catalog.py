"""Named-query catalog (C1-C4), parameter checks (R13) and audit log.

``run(tables, key, params)`` binds parameters by name, validates ranges,
writes the call to the audit table and then returns the lazy result DataFrame.
``run_rows`` gives the rows, their number and the elapsed time. Entry 14 inserts rows, entry 15 lists the
audit table.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.append import AppendResult, append_logs
from ..operators.model import Tables
from ..sources.store import append_wide
from . import queries as Q


@dataclass(frozen=True)
class Param:
    name: str
    kind: str                 # timestamp | date | text | int
    required: bool = True
    default: object = None


@dataclass(frozen=True)
class QueryDef:
    key: int
    title: str
    params: tuple
    fn: Callable
    fixed: dict = field(default_factory=dict)   # C3: bindings the UI never asks for


TS, DAY = "timestamp", "date"
CATALOG = {
    1: QueryDef(1, "Total logs per action type in a time range",
                (Param("start", TS), Param("end", TS)), Q.q01_total_logs_per_action_type),
    2: QueryDef(2, "Logs per day for an action type in a time range",
                (Param("action_name", "text"), Param("start", TS), Param("end", TS)),
                Q.q02_logs_per_day_for_action),
    3: QueryDef(3, "Most common action per source IP on a day",
                (Param("day", DAY),), Q.q03_most_common_action_per_source_ip),
    4: QueryDef(4, "Top blocks by actions per day in a date range",
                (Param("start_day", DAY), Param("end_day", DAY)),
                Q.q04_top_blocks_by_actions_per_day, {"limit": 5}),
    5: QueryDef(5, "Referrers that led to more than one resource", (),
                Q.q05_referrers_multiple_resources),
    6: QueryDef(6, "Second most common resource", (), Q.q06_second_most_common_resource),
    7: QueryDef(7, "Access logs with size below a number", (Param("max_size", "int"),),
                Q.q07_access_logs_below_size),
    8: QueryDef(8, "Blocks replicated and served on the same day", (),
                Q.q08_blocks_rep_and_serv_same_day),
    9: QueryDef(9, "Blocks replicated and served on the same day and hour", (),
                Q.q09_blocks_rep_and_serv_same_day_hour),
    10: QueryDef(10, "Access logs by user agent version", (Param("version", "text"),),
                 Q.q10_access_logs_by_user_agent_version),
    11: QueryDef(11, "IPs that issued an HTTP method in a time range",
                 (Param("method", "text"), Param("start", TS), Param("end", TS)),
                 Q.q11_ips_with_method_in_range, {"log_type_name": "ACCESS"}),
    12: QueryDef(12, "IPs that issued two HTTP methods in a time range",
                 (Param("method1", "text"), Param("method2", "text"), Param("start", TS),
                  Param("end", TS)),
                 Q.q12_ips_with_two_methods_in_range, {"log_type_name": "ACCESS"}),
    13: QueryDef(13, "IPs that issued N distinct HTTP methods in a time range",
                 (Param("start", TS), Param("end", TS)),
                 Q.q13_ips_with_n_methods_in_range,
                 {"log_type_name": "ACCESS", "required_methods": 4}),
    14: QueryDef(14, "Insert log rows", (), append_logs),
    15: QueryDef(15, "Audit listing", (), None),
}


def _coerce(p: Param, v):
    if v is None or v == "":
        if p.required:
            raise ValueError(f"missing required parameter {p.name}")   # C4: no 'null' string
        return p.default
    if p.kind == TS:
        return v if isinstance(v, datetime) else datetime.fromisoformat(str(v))
    if p.kind == DAY:
        return v if isinstance(v, date) else date.fromisoformat(str(v))
    if p.kind == "int":
        return int(v)
    return str(v)


def bind(qd: QueryDef, params: dict) -> dict:
    """C2 binding + R13 checks: time start < end, day start <= end."""
    vals = {p.name: _coerce(p, params.get(p.name)) for p in qd.params}
    if "start" in vals and "end" in vals and not vals["start"] < vals["end"]:
        raise ValueError("start must be before end")
    if "start_day" in vals and "end_day" in vals and not vals["start_day"] <= vals["end_day"]:
        raise ValueError("start day must not be after end day")
    return {**qd.fixed, **vals}


class AuditLog:
    """Append-only audit table ``(id, user_id, query_text, params,
    executed_at)``. A call is one row, written before the query runs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, user_id, query_text: str, params: dict) -> None:
        text = ", ".join("" if v is None else str(v) for v in params.values())   # F18
        row = (time.time_ns() // 1000, user_id, query_text, text, datetime.now().astimezone())
        (self.spark.createDataFrame([row], S.USER_QUERY_LOG).coalesce(1)
             .write.mode("append").parquet(self.path))

    def compact(self, path: str) -> "AuditLog":
        """A copy with few files under another path."""
        self.spark.read.schema(S.USER_QUERY_LOG).parquet(self.path).coalesce(1).write.parquet(path)
        return AuditLog(self.spark, path)

    def listing(self) -> DataFrame:
        """Q15: audit rows, newest first."""
        return (self.spark.read.schema(S.USER_QUERY_LOG).parquet(self.path)
                    .orderBy(F.desc("executed_at"), F.desc("id")))


def run(t: Tables, key: int, params: dict | None = None, user_id=None,
        audit: AuditLog | None = None) -> DataFrame:
    """Run catalog query ``key`` (1-13, or 15 with an audit log); it is audited first."""
    qd = CATALOG[key]
    if key == 14:
        raise ValueError("entry 14 takes rows: use insert()")
    if key == 15 and audit is None:
        raise ValueError("entry 15 lists an audit log: give one")
    bound = bind(qd, params or {})
    if audit is not None:
        name = "q15_audit_listing" if key == 15 else qd.fn.__name__
        audit.record(user_id, name, {p.name: bound[p.name] for p in qd.params})
    return audit.listing() if key == 15 else qd.fn(t, **bound)


class Rows:
    """Result of :func:`run_rows`: iterate once over the rows as dicts.

    ``columns``, ``row_count`` and ``elapsed_ms`` are known before the first row is read.
    """

    def __init__(self, held: DataFrame, row_count: int, elapsed_ms: float):
        self.columns, self.row_count, self.elapsed_ms, self._held = held.columns, row_count, elapsed_ms, held

    def __len__(self) -> int:
        return self.row_count

    def __iter__(self) -> Iterator[dict]:
        try:
            for r in self._held.toLocalIterator():
                yield r.asDict()
        finally:
            self.close()

    def close(self) -> None:
        """Free the result; iterating to the end does it too."""
        self._held.unpersist()


def run_rows(t: Tables, key: int, params: dict | None = None, user_id=None,
             audit: AuditLog | None = None) -> Rows:
    """Run an entry once and give its rows, their number and the elapsed milliseconds.

    The call is audited first, outside the measured time. The query runs once, into storage on
    the executors (memory, then disk), while an observation counts its rows: time and count
    come from that one execution. Reading the rows, a partition at a time in the driver's memory
    and in the result's order, is not part of the time.
    """
    held = run(t, key, params, user_id, audit).persist(StorageLevel.MEMORY_AND_DISK)
    seen = Observation()
    start = time.perf_counter()
    held.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    elapsed = (time.perf_counter() - start) * 1000
    return Rows(held, seen.get["rows"], elapsed)


def insert(t: Tables, requests: DataFrame, root: str, user_id=None, audit: AuditLog | None = None,
           batch: str | None = None, **options) -> tuple[int, AppendResult]:
    """Entry 14: append request rows to the store at ``root``; rows added and the rejects."""
    if audit is not None:
        audit.record(user_id, "q14_insert", {"root": root})
    out = append_logs(t, requests, **options)
    return append_wide(out.accepted, root, batch), out
