"""Archived forms of some queries, kept as options."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.model import Tables


def second_resource_offset(t: Tables) -> DataFrame:
    """Second row of resources by count (always one row if two exist).
    A tie-break on the resource makes the pick deterministic; the sort is a
    top-k (``TakeOrderedAndProject``) over the per-resource counts."""
    counts = t.log_access_detail.groupBy("resource").agg(F.count(F.lit(1)).alias("frequency"))
    return counts.orderBy(F.desc("frequency"), F.asc_nulls_first("resource")).offset(1).limit(1)


def blocks_same_day_hour_text_key(t: Tables) -> DataFrame:
    """F16: same-day-and-hour blocks grouped by the text key date||hour."""
    src = t.log_entry
    act = t.action_type.filter(F.col("name").isin("replicate", "served"))
    key = F.concat(F.to_date("log_timestamp").cast("string"), F.hour("log_timestamp").cast("string"))
    j = src.join(act, src["action_type_id"] == act["id"], "inner")
    return (j.groupBy(F.col("block_id"), key.alias("_k"))
             .agg((F.bool_or(act["name"] == "replicate") & F.bool_or(act["name"] == "served"))
                  .alias("_both"))
             .filter("_both").select("block_id").orderBy(F.desc_nulls_first("block_id")))
