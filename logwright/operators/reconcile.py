"""Reconciling load (S5 with K1-K4 enforced): every row is accepted or rejected with a reason.

The relational store refuses rows that break a constraint. Here a load of separate
tables sorts them: dimension rows first, then entries against the accepted dimensions,
then details against the accepted entries, so that what is accepted satisfies every
constraint together.

* Required values and foreign keys are judged row by row (joins with the dimensions).
* Of several rows with one key the smallest (column by column, NULL first) is accepted and the
  others are duplicates. The smallest is found by a partial aggregation, so a key that a
  third of all rows share meets in no task; equal rejected rows are one row with a
  number of ``copies``.
* Entries and details meet once, in a full outer join on the id whose two sides are
  already partitioned by it. An entry keeps its detail, or none; a detail without an
  accepted ACCESS entry is rejected. Nothing is invented and nothing disappears:
  rows in = accepted rows + sum of ``copies``, table by table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .model import Tables, union_all

DUPLICATE, NO_ENTRY, NOT_ACCESS = "duplicate ", "no such log_entry", "log_entry is not an ACCESS entry"


@dataclass
class Reconciled:
    log_type: DataFrame
    action_type: DataFrame
    wide: DataFrame       # accepted entries with their details, action_name, log_date, has_detail
    rejects: DataFrame    # table, line, reason, copies


def _required(table: str) -> Column:
    """Reason for the first required column that is NULL, else NULL."""
    checks = [F.when(F.col(f.name).isNull(), F.lit(f"{f.name} is required"))
              for f in S.ALL_TABLES[table].fields if not f.nullable]
    return F.coalesce(*checks)


def _row(table: str) -> Column:
    return F.struct(*[f.name for f in S.ALL_TABLES[table].fields])


def _rejected(rows: DataFrame, table: str, row: Column, reason: Column, copies: Column | None = None) -> DataFrame:
    """Reject rows, equal ones counted."""
    out = rows.select(F.lit(table).alias("table"), F.to_csv(row).alias("line"), reason.alias("reason"),
                      (F.lit(1).cast("long") if copies is None else copies.cast("long")).alias("copies"))
    return out.groupBy("table", "line", "reason").agg(F.sum("copies").alias("copies"))


def _one_per_key(rows: DataFrame, table: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(key, row, n): the smallest row of each key; and the other rows as rejects.

    ``rows`` has the table's columns and no NULL key.
    """
    kept = rows.select(F.col(key).alias("key"), _row(table).alias("row")) \
        .groupBy("key").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("n"))
    # rows of keys that occur twice, equal ones counted; the kept one is taken off
    twice = kept.filter("n > 1").select(F.col("key").alias("_key"), F.col("row").alias("_kept"))
    cols = [f.name for f in S.ALL_TABLES[table].fields]
    more = (rows.select(*cols).join(twice, F.col(key) == F.col("_key"))
            .groupBy(*cols, "_kept").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_n", F.col("_n") - (_row(table).eqNullSafe(F.col("_kept"))).cast("long"))
            .filter("_n > 0"))
    return kept, _rejected(more, table, _row(table), F.lit(f"{DUPLICATE}{key}"), F.col("_n"))


def _dimension(rows: DataFrame, table: str, have: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Accepted rows of a dimension (unique id, unique name) and its rejects.

    ``have``: rows that the store holds already. Equal ones are accepted again (the store keeps
    one), rows that give a known id or name another partner are duplicates.
    """
    cols = [f.name for f in S.ALL_TABLES[table].fields]
    judged = rows.select(*cols, _required(table).alias("_reason"))
    rejects = [_rejected(judged.filter("_reason IS NOT NULL"), table, _row(table), F.col("_reason"))]
    good = judged.filter("_reason IS NULL").select(*cols)
    if have is not None:
        for key, other in (("id", "name"), ("name", "id")):
            known = have.select(F.col(key).alias("_k"), F.col(other).alias("_o"))
            j = good.join(known, F.col(key) == F.col("_k"), "left")
            clash = F.col("_k").isNotNull() & (F.col(other) != F.col("_o"))
            rejects.append(_rejected(j.filter(clash), table, _row(table), F.lit(f"{DUPLICATE}{key}")))
            good = j.filter(~clash).select(*cols)
    for key in ("id", "name"):
        kept, more = _one_per_key(good, table, key)
        rejects.append(more)
        good = kept.select("row.*")
    return good, union_all(rejects)


def reconcile(t: Tables, have: Tables | None = None) -> Reconciled:
    """Sort the rows of separate tables into accepted and rejected ones.

    ``have``: the tables of a store that the load adds to; entries whose id it holds are
    duplicates, and its dimensions count as given.
    """
    log_type, type_rejects = _dimension(t.log_type, "log_type", have and have.log_type)
    action_type, action_rejects = _dimension(t.action_type, "action_type", have and have.action_type)
    rejects = [type_rejects, action_rejects]
    types, actions = log_type, action_type
    if have is not None:
        types = types.union(have.log_type.select("id", "name")).distinct()
        actions = actions.union(have.action_type.select("id", "name")).distinct()

    judged = (t.log_entry.select(*S.ENTRY_FIELDS)
              .join(types.select(F.col("id").alias("_type"), F.col("name").alias("_type_name")),
                    F.col("log_type_id") == F.col("_type"), "left")
              .join(actions.select(F.col("id").alias("_action"), F.col("name").alias("action_name")),
                    F.col("action_type_id") == F.col("_action"), "left"))
    reason = F.coalesce(
        _required("log_entry"), F.when(F.col("_type").isNull(), F.lit("no such log_type")),
        F.when(F.col("action_type_id").isNotNull() & F.col("_action").isNull(), F.lit("no such action_type")))
    if have is not None:
        judged = judged.join(have.log_entry.select(F.col("id").alias("_have")), F.col("id") == F.col("_have"), "left")
        reason = F.coalesce(reason, F.when(F.col("_have").isNotNull(), F.lit(f"{DUPLICATE}id")))
    judged = judged.withColumn("_reason", reason)
    rejects.append(_rejected(judged.filter("_reason IS NOT NULL"), "log_entry", _row("log_entry"), F.col("_reason")))
    entries, more = _one_per_key(judged.filter("_reason IS NULL").select(*S.ENTRY_FIELDS), "log_entry", "id")
    rejects.append(more)

    judged = t.log_access_detail.select(*S.DETAIL_FIELDS, _required("log_access_detail").alias("_reason"))
    rejects.append(_rejected(judged.filter("_reason IS NOT NULL"), "log_access_detail", _row("log_access_detail"),
                             F.col("_reason")))
    details, more = _one_per_key(judged.filter("_reason IS NULL").drop("_reason"), "log_access_detail", "log_entry_id")
    rejects.append(more)

    both = (entries.select("key", F.col("row").alias("entry"))
            .join(details.select("key", F.col("row").alias("detail")), "key", "full_outer"))
    is_access = F.col("entry.log_type_id") == F.lit(S.ACCESS)
    lost = F.when(F.col("entry").isNull(), F.lit(NO_ENTRY)).when(~is_access, F.lit(NOT_ACCESS))
    rejects.append(_rejected(both.filter(F.col("detail").isNotNull() & lost.isNotNull()), "log_access_detail",
                             F.col("detail"), lost))
    has_detail = F.col("detail").isNotNull() & is_access
    accepted = both.filter(F.col("entry").isNotNull()).select(
        *[F.col(f"entry.{c}").alias(c) for c in S.ENTRY_FIELDS],
        *[F.when(has_detail, F.col(f"detail.{c}")).alias(c) for c in S.DETAIL_VALUE_FIELDS],
        F.when(is_access, has_detail).alias("has_detail"),
        F.to_date("entry.log_timestamp").alias("log_date"))
    names = actions.select(F.col("id").alias("_action"), F.col("name").alias("action_name"))
    wide = accepted.join(names, F.col("action_type_id") == F.col("_action"), "left").drop("_action")
    return Reconciled(log_type, action_type, wide, union_all(rejects))
