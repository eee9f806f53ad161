"""Integrity checks (K1-K4): the constraints the relational store enforced,
re-expressed as DataFrames of violating rows (empty = constraint holds)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .model import Tables


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """K1: key values that occur more than once (primary key / unique)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
              .filter(F.col("occurrences") > 1))


def null_violations(df: DataFrame, *cols: str) -> DataFrame:
    """K2: rows where a NOT NULL column is NULL."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """K3: child rows whose non-NULL foreign key has no parent row."""
    p = parent.select(F.col(pk).alias("_pk"))
    return (child.filter(F.col(fk).isNotNull())
                 .join(p, F.col(fk) == F.col("_pk"), "left_anti"))


def detail_scope_violations(t: Tables) -> DataFrame:
    """K4: detail rows without an ACCESS entry (covers both missing entries
    and details attached to HDFS entries)."""
    access_ids = t.log_entry.filter(F.col("log_type_id") == S.ACCESS).select(F.col("id").alias("_id"))
    return t.log_access_detail.join(access_ids, F.col("log_entry_id") == F.col("_id"), "left_anti")


UNIQUE = (("log_type", ("id",)), ("log_type", ("name",)), ("action_type", ("id",)),
          ("action_type", ("name",)), ("log_entry", ("id",)), ("log_access_detail", ("log_entry_id",)))
FOREIGN = (("log_entry", "log_type_id", "log_type", "id"), ("log_entry", "action_type_id", "action_type", "id"),
           ("log_access_detail", "log_entry_id", "log_entry", "id"))


def _tags(table: str, keys: dict, extra=()) -> Column:
    """Tagged keys of a row: its key values with what they are, and its missing values."""
    tag = lambda domain, key, role: F.struct(
        F.lit(domain).alias("domain"), key.cast("string").alias("key"), F.lit(role).alias("role"))
    found = [F.when(F.col(c).isNotNull(), tag(domain, F.col(c), role)) for c, (domain, role) in keys.items()]
    missing = [F.when(F.col(f.name).isNull(), tag("missing", F.lit(f"{table}({f.name})"), "row"))
               for f in S.ALL_TABLES[table].fields if not f.nullable]
    return F.explode(F.filter(F.array(*found, *missing, *extra), lambda x: x.isNotNull())).alias("t")


def summary(t: Tables) -> DataFrame:
    """Every constraint with its number of violations: one row per constraint.

    ``check`` names the constraint (``unique log_entry(id)``, ``not null
    log_entry(log_timestamp)``, ``foreign key log_entry(log_type_id)``, ``detail scope``).

    Each table is read once: its rows become tagged keys, and one aggregation by (domain, key)
    holds for every key how often it occurs in each role. Partial aggregation folds keys that
    many rows share (a log type) before the only shuffle of rows.
    """
    access = F.when((F.col("log_type_id") == S.ACCESS) & F.col("id").isNotNull(), F.struct(
        F.lit("entry").alias("domain"), F.col("id").cast("string").alias("key"), F.lit("access").alias("role")))
    parts = [
        t.log_type.select(_tags("log_type", {"id": ("type", "own"), "name": ("type name", "own")})),
        t.action_type.select(_tags("action_type", {"id": ("action", "own"), "name": ("action name", "own")})),
        t.log_entry.select(_tags("log_entry", {"id": ("entry", "own"), "log_type_id": ("type", "other"),
                                               "action_type_id": ("action", "other")}, [access])),
        t.log_access_detail.select(_tags("log_access_detail", {"log_entry_id": ("entry", "other")}))]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    of = lambda role: F.count_if(F.col("t.role") == role)
    keys = rows.groupBy("t.domain", "t.key").agg(of("own").alias("own"), of("other").alias("other"),
                                                 of("access").alias("access"), of("row").alias("missing"))
    in_domain = lambda d, cond, value: F.sum(F.when((F.col("domain") == d) & cond, value).otherwise(0))
    lost = lambda table, col: in_domain("missing", F.col("key") == f"{table}({col})", F.col("missing"))
    domain = {("log_type", "id"): "type", ("log_type", "name"): "type name", ("action_type", "id"): "action",
              ("action_type", "name"): "action name", ("log_entry", "id"): "entry"}
    checks = {}
    for table, (key,) in UNIQUE:
        found = in_domain(domain[table, key], F.col("own") > 1, 1) if (table, key) in domain \
            else in_domain("entry", F.col("other") > 1, 1)  # details by their entry's id
        checks[f"unique {table}({key})"] = found
    for table, schema in S.ALL_TABLES.items():
        for f in schema.fields:
            if not f.nullable:
                checks[f"not null {table}({f.name})"] = lost(table, f.name)
    for table, fk, parent, pk in FOREIGN:
        checks[f"foreign key {table}({fk})"] = in_domain(domain[parent, pk], F.col("own") == 0, F.col("other"))
    checks["detail scope"] = in_domain("entry", F.col("access") == 0, F.col("other")) \
        + lost("log_access_detail", "log_entry_id")
    one = keys.agg(*[F.coalesce(v, F.lit(0)).cast("long").alias(f"c{k}") for k, v in enumerate(checks.values())])
    return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"c{k}").alias("violations"))
                                          for k, name in enumerate(checks)])).alias("r")).select("r.*")
