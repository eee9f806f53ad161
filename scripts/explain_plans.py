"""Ingest the derived raw text of one scale factor into a fresh store and
print, per query, the physical-plan facts that matter at scale (markdown).

usage: python scripts/explain_plans.py [sf_dir] > PLANS.md
"""

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from bench import QUERY_CALLS  # noqa: E402
from logwright.session import build_session  # noqa: E402
from logwright.sources.fixtures import fixture_lines  # noqa: E402
from logwright.sources.store import ingest  # noqa: E402


def facts(plan: str) -> dict:
    part = re.findall(r"^PartitionFilters: \[(.*)\]$", plan, re.M)
    pushed = re.findall(r"^PushedFilters: \[(.*)\]$", plan, re.M)
    schema = re.findall(r"^ReadSchema: (.*)$", plan, re.M)
    return {
        "exchanges": len(re.findall(r"^\(\d+\) Exchange$", plan, re.M)),
        "broadcast joins": len(re.findall(r"^\(\d+\) BroadcastHashJoin", plan, re.M)),
        "sort-merge joins": len(re.findall(r"^\(\d+\) SortMergeJoin", plan, re.M)),
        "partition filters": "; ".join(p for p in part if p) or "-",
        "pushed filters": "; ".join(p for p in pushed if p) or "-",
        "read schema": "; ".join(schema) or "-",
        "dynamic pruning": "yes" if "dynamicpruning" in plan else "no",
        "top-k": "yes" if re.search(r"^\(\d+\) TakeOrderedAndProject", plan, re.M) else "no",
    }


def main():
    sf_dir = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01").rstrip("/")
    work = tempfile.mkdtemp(prefix="plans-", dir="/tmp")
    spark = build_session("local[8]", extra={"spark.checkpoint.dir": f"{work}/ckpt"})
    kinds = ("access", "dataxceiver", "namesystem")
    lines = fixture_lines(spark, sf_dir)
    for k in kinds:
        lines.filter(F.col("kind") == k).select("line").write.text(f"{work}/raw/{k}")
    t = ingest(spark, {k: f"{work}/raw/{k}" for k in kinds}, f"{work}/store").tables
    print("# Physical plans of Q1-Q13 on the Parquet store\n")
    print(f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf_dir)}` "
          "(initial AQE plan; AQE may coalesce partitions at run time).\n")
    for name, call in QUERY_CALLS.items():
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = call(t)._jdf.queryExecution().explainString(mode)
        print(f"## {name}\n")
        for k, v in facts(plan).items():
            print(f"* **{k}**: `{v}`" if v not in ("-", "no") else f"* **{k}**: {v}")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
