"""The thirteen analytics queries (Q1-Q13) as DataFrame functions.

Each takes :class:`Tables` plus its parameters and returns a lazy DataFrame;
Catalyst pushes the time predicates and the column selection into the
Parquet scan, and with the partitioned wide store also prunes ``log_type_id``
/ ``log_date`` directories. Joins carry no hints: the planner broadcasts a
dimension when its size in bytes is below ``autoBroadcastJoinThreshold``. Where a
query counts per key (Q1, Q3) the fact side is reduced before the join, so only
per-key partial results move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.model import Tables, has_detail, lit_like

RESULT_14 = S.ENTRY_FIELDS + S.DETAIL_VALUE_FIELDS


def _actions(t: Tables, names=None) -> DataFrame:
    """Action dimension, optionally filtered by name."""
    a = t.action_type
    return a if names is None else a.filter(F.col("name").isin(*names))


def _log_types(t: Tables, name) -> DataFrame:
    return t.log_type.filter(F.col("name") == F.lit(name))


def _day(df: DataFrame):
    return F.col("log_date") if "log_date" in df.columns else F.to_date("log_timestamp")


def _action_counts(t: Tables, start, end) -> DataFrame:
    """(day, action_type_id, n) of ``start <= ts <= end``; a pair may come twice.

    The whole days inside the range are read from the rollup, and rows only on the days at
    its two ends."""
    per = ["day", "action_type_id"]
    lo, hi = (lit_like(v, t.wide, "log_timestamp") for v in (start, end))
    first = F.when(lo == F.date_trunc("day", lo), F.to_date(lo)).otherwise(F.date_add(F.to_date(lo), 1))
    last = F.to_date(hi)  # its own day is an edge: the bound is closed
    edge = t.entries_in(start, end, closed=True, days=lambda d: (d < first) | (d == last))
    counted = edge.groupBy(F.to_date("log_timestamp").alias("day"), "action_type_id").agg(F.count(F.lit(1)).alias("n"))
    whole = (t.rollups.days.filter((F.col("log_date") >= first) & (F.col("log_date") < last))
             .select(F.col("log_date").alias("day"), "action_type_id", F.col("rows").alias("n")))
    return counted.select(*per, "n").unionByName(whole)


# Q1 -------------------------------------------------------------------------
def q01_total_logs_per_action_type(t: Tables, start, end) -> DataFrame:
    """Logs per action name with ``start <= ts <= end``, most first."""
    if t.rollups is None:
        per_id = (t.entries_in(start, end, closed=True)
                   .groupBy("action_type_id").agg(F.count(F.lit(1)).alias("n")))
    else:
        per_id = _action_counts(t, start, end)
    act = _actions(t)
    # Names may repeat in the dimension: the few rows per id are added up by name.
    return (per_id.join(act, per_id["action_type_id"] == act["id"], "inner")
                  .groupBy(act["name"].alias("action_type_name"))
                  .agg(F.sum("n").cast("bigint").alias("logs"))
                  .orderBy(F.desc("logs"), "action_type_name"))


# Q2 -------------------------------------------------------------------------
def q02_logs_per_day_for_action(t: Tables, action_name, start, end) -> DataFrame:
    """Logs per day for one action with ``start <= ts <= end``; by count."""
    act = _actions(t, [action_name])
    if t.rollups is None:
        le = t.entries_in(start, end, closed=True)
        per_day = (le.join(act, le["action_type_id"] == act["id"], "inner")
                     .groupBy(F.to_date(le["log_timestamp"]).alias("day"))
                     .agg(F.count(F.lit(1)).alias("total_logs")))
    else:
        n = _action_counts(t, start, end)
        per_day = (n.join(act, n["action_type_id"] == act["id"], "inner")
                    .groupBy("day").agg(F.sum("n").cast("bigint").alias("total_logs")))
    return (per_day
              # One row per day of the range: a single-partition sort.
              .repartition(1).sortWithinPartitions(F.desc("total_logs")))


# Q3 -------------------------------------------------------------------------
def q03_most_common_action_per_source_ip(t: Tables, day) -> DataFrame:
    """Per source address, the action(s) with the highest count on ``day``
    (ties kept; a NULL address is a group of its own).

    Wide rows hold the action's name, so they are counted by it in one exchange."""
    if t.wide is not None:
        rows = t.on_days(t.wide, day, day, hi_inclusive=True).filter(F.col("action_name").isNotNull())
        per_name = (rows.groupBy("source_ip", F.col("action_name").alias("action_type_name"))
                        .agg(F.count(F.lit(1)).alias("frequency")))
    else:
        le = t.entries_on_days(day, day, hi_inclusive=True)
        per_id = le.groupBy("source_ip", "action_type_id").agg(F.count(F.lit(1)).alias("n"))
        act = _actions(t)
        j = per_id.join(act, per_id["action_type_id"] == act["id"], "inner")
        per_name = (j.groupBy("source_ip", act["name"].alias("action_type_name"))
                     .agg(F.sum("n").cast("bigint").alias("frequency")))
    w = Window.partitionBy("source_ip").orderBy(F.desc("frequency"))
    return (per_name.withColumn("rnk", F.rank().over(w))
                    .filter(F.col("rnk") == 1)
                    .select("source_ip", "action_type_name", "frequency")
                    # Secondary keys keep ORDER BY frequency DESC but let the
                    # range partitioner split a run of equal counts.
                    .orderBy(F.desc("frequency"), "source_ip", "action_type_name"))


# Q4 -------------------------------------------------------------------------
def q04_top_blocks_by_actions_per_day(t: Tables, start_day, end_day, limit: int = 5) -> DataFrame:
    """Top ``limit`` (block, day) pairs by non-NULL action count, days in
    ``[start_day, end_day)``. Ties are broken by block id, then day."""
    if t.rollups is None:
        le = t.entries_on_days(start_day, end_day, hi_inclusive=False)
        per = (le.filter(F.col("block_id").isNotNull())
                 .groupBy("block_id", F.to_date("log_timestamp").alias("day"))
                 .agg(F.count("action_type_id").cast("bigint").alias("total_actions")))
    else:  # days are whole: no row is read
        day = F.col("log_date")
        per = (t.rollups.blocks.filter((day >= F.lit(start_day).cast("date")) & (day < F.lit(end_day).cast("date")))
                .groupBy("block_id", day.alias("day")).agg(F.sum("actions").cast("bigint").alias("total_actions")))
    return (per.orderBy(F.desc("total_actions"), F.asc("block_id"), F.asc("day"))
              .limit(int(limit)))


# Q5 -------------------------------------------------------------------------
def q05_referrers_multiple_resources(t: Tables) -> DataFrame:
    """Referrers with more than one non-NULL resource row (rows, not distinct)."""
    return (t.log_access_detail.filter(F.col("referrer").isNotNull())
             .groupBy("referrer")
             .agg(F.count("resource").alias("resource_frequency"))
             .filter(F.col("resource_frequency") > 1))


# Q6 -------------------------------------------------------------------------
def q06_second_most_common_resource(t: Tables) -> DataFrame:
    """Resources at rank 2 of ``RANK() OVER (ORDER BY count DESC)``.

    Rank 2 exists only when exactly one resource holds the top count. The
    rank is read from the histogram of counts (one row per distinct count,
    at most ~sqrt(2 * rows) of them), so no single task ever receives the
    per-resource rows, however many of them tie."""
    counts = t.log_access_detail.groupBy("resource").agg(F.count(F.lit(1)).alias("frequency"))
    levels = counts.groupBy("frequency").agg(F.count(F.lit(1)).alias("n"))
    top2 = levels.orderBy(F.desc("frequency")).limit(2)
    w = Window.orderBy(F.desc("frequency")).rowsBetween(Window.unboundedPreceding, -1)
    second = (top2.withColumn("above", F.coalesce(F.sum("n").over(w), F.lit(0)))
                  .filter(F.col("above") == 1).select("frequency"))
    return (counts.join(F.broadcast(second), "frequency", "inner")   # <= 1 row by construction
                  .select("resource", "frequency"))


# Q7 / Q10 --------------------------------------------------------------------
def _entry_with_detail(t: Tables, entry_cond, detail_cond) -> DataFrame:
    """``log_entry JOIN log_access_detail ON id = log_entry_id`` + filters.

    In the wide layout both halves live in one row of an ACCESS partition,
    so the join is a filter on one scan. Otherwise a plain equi-join."""
    if t.wide is not None:
        w = t.wide.filter(has_detail(t.wide))
        if entry_cond is not None:
            w = w.filter(entry_cond)
        if detail_cond is not None:
            w = w.filter(detail_cond)
        return w.select(*RESULT_14)
    le, lad = t.log_entry, t.log_access_detail
    if entry_cond is not None:
        le = le.filter(entry_cond)
    if detail_cond is not None:
        lad = lad.filter(detail_cond)
    return le.join(lad, le["id"] == lad["log_entry_id"], "inner").select(*RESULT_14)


def q07_access_logs_below_size(t: Tables, max_size) -> DataFrame:
    """Entry + detail of access logs with ``size_bytes < max_size``."""
    cond = F.col("size_bytes").isNotNull() & (F.col("size_bytes") < F.lit(max_size).cast("bigint"))
    return _entry_with_detail(t, cond, None)


def q10_access_logs_by_user_agent_version(t: Tables, version) -> DataFrame:
    """Entry + detail where the agent contains ``Mozilla/<version>``, any
    case; ``%``/``_`` inside ``version`` act as wildcards."""
    pattern = F.concat(F.lit("%Mozilla/"), F.lit(version).cast("string"), F.lit("%"))
    return _entry_with_detail(t, None, F.ilike(F.col("user_agent"), pattern))


# Q8 / Q9 ---------------------------------------------------------------------
def _rep_and_serv(t: Tables, by_hour: bool) -> DataFrame:
    src = t.wide if t.wide is not None else t.log_entry
    names = ["replicate", "served"]
    if t.wide is not None:  # the name is stored with the row: a literal filter on the scan
        src = src.filter(F.col("action_name").isin(*names))
    act = _actions(t, names)
    j = src.join(act, src["action_type_id"] == act["id"], "inner")
    keys = [F.col("block_id"), _day(src).alias("_day")]
    if by_hour:
        keys.append(F.hour("log_timestamp").alias("_hour"))
    name = act["name"]
    return (j.groupBy(*keys)
             .agg((F.bool_or(name == "replicate") & F.bool_or(name == "served")).alias("_both"))
             .filter(F.col("_both"))
             .select("block_id")
             .orderBy(F.desc_nulls_first("block_id")))


def q08_blocks_rep_and_serv_same_day(t: Tables) -> DataFrame:
    """Block ids with both a replicate and a served action on one day, once
    per such day, highest id first (NULL first)."""
    return _rep_and_serv(t, by_hour=False)


def q09_blocks_rep_and_serv_same_day_hour(t: Tables) -> DataFrame:
    """As Q8 with the same day and hour."""
    return _rep_and_serv(t, by_hour=True)


# Q11-Q13 ---------------------------------------------------------------------
def _typed_entries(t: Tables, log_type_name, start, end, names=None):
    le = t.entries_in(start, end, closed=False)
    lt = _log_types(t, log_type_name)
    act = _actions(t, names)
    return (le.join(lt, le["log_type_id"] == lt["id"], "inner")
              .join(act, le["action_type_id"] == act["id"], "inner")
              .select(le["source_ip"], act["name"].alias("_name")))


def q11_ips_with_method_in_range(t: Tables, log_type_name, method, start, end) -> DataFrame:
    """Distinct source addresses with ``method`` in ``[start, end)``."""
    return _typed_entries(t, log_type_name, start, end, [method]).select("source_ip").distinct()


def q12_ips_with_two_methods_in_range(t: Tables, log_type_name, method1, method2,
                                      start, end) -> DataFrame:
    """Source addresses that used both methods in ``[start, end)``; empty
    when the two methods are equal (two distinct names are required)."""
    e = _typed_entries(t, log_type_name, start, end, [method1, method2])
    n = F.col("_name")
    both = (F.bool_or(n == F.lit(method1)) & F.bool_or(n == F.lit(method2))
            & (F.lit(method1) != F.lit(method2)))
    return (e.groupBy("source_ip").agg(both.alias("_both"))
             .filter(F.col("_both")).select("source_ip"))


#: Distinct action names up to which Q13 keeps a bitmap per address; a word holds 62 of them.
MAX_BITS, WORD_BITS = 496, 62


def q13_ips_with_n_methods_in_range(t: Tables, log_type_name, required_methods,
                                    start, end) -> DataFrame:
    """Source addresses with exactly ``required_methods`` distinct methods in
    ``[start, end)``, with the sorted method list joined by ``|``.

    The dimension's names are numbered in sorted order (read once when the query is made: at most
    2 x ``MAX_BITS`` + 1 short rows), and an address is a few words of bits: one aggregation with
    partial ``bit_or`` states of fixed size, names looked up after the filter. With more names than
    that, distinct (address, action id) pairs are made first and named afterwards."""
    le = t.entries_in(start, end, closed=False)
    lt = _log_types(t, log_type_name)
    typed = le.join(lt, le["log_type_id"] == lt["id"], "left_semi").select("source_ip", "action_type_id")
    act = _actions(t)
    rows = act.select("name").limit(2 * MAX_BITS + 1).collect()
    names = sorted({r["name"] for r in rows})
    if len(rows) > 2 * MAX_BITS or len(names) > MAX_BITS:
        pairs = typed.distinct()
        named = pairs.join(act, pairs["action_type_id"] == act["id"], "inner")
        sets = (named.groupBy("source_ip").agg(F.collect_set("name").alias("_set"))
                     .select("source_ip", F.size("_set").cast("int").alias("cnt"), F.array_sort("_set").alias("_names")))
    else:
        every = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        numbered = act.select(F.col("id").alias("_id"), (F.array_position(every, F.col("name")) - 1).alias("_k"))
        bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), (k % WORD_BITS).cast("int"))
        words = range(-(-max(len(names), 1) // WORD_BITS))
        bits = (typed.join(numbered, F.col("action_type_id") == F.col("_id"), "inner").groupBy("source_ip")
                .agg(*[F.bit_or(F.when(F.floor(F.col("_k") / WORD_BITS) == w, bit(F.col("_k"))).otherwise(F.lit(0)))
                       .alias(f"_w{w}") for w in words]))
        word = lambda i: F.array(*[F.col(f"_w{w}") for w in words])[F.floor(i / WORD_BITS).cast("int")]
        count = sum((F.bit_count(f"_w{w}") for w in words[1:]), F.bit_count("_w0"))
        sets = bits.select("source_ip", count.cast("int").alias("cnt"),
                           F.filter(every, lambda n, i: word(i).bitwiseAND(bit(i)) != 0).alias("_names"))
    return (sets.filter(F.col("cnt") == F.lit(required_methods).cast("int"))
             .select("source_ip", "cnt", F.array_join("_names", "|").alias("methods"))
             # Every row has cnt = n: sorting on cnt alone would range-partition
             # all rows into one task; the address spreads them.
             .orderBy(F.desc("cnt"), "source_ip"))
