"""Complete groups of rows from key-sorted Arrow batches, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import written


_WIDE = {pa.string(): pa.large_string(), pa.binary(): pa.large_binary()}


def changes(table: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """First row of each run of equal keys."""
    n = table.num_rows
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for k in keys:
        col = table.column(k)
        if n > 1:
            diff = pc.not_equal(col.slice(1), col.slice(0, n - 1))
            new[1:] |= diff.fill_null(True).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def whole_groups(batches, keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold whole groups, with the borders of the groups.

    The input is sorted by ``keys``; a group that a batch border cuts is carried over, so
    memory follows the largest group (groups must be bounded) and the batch.
    """
    carry = None
    for b in batches:
        if not b.num_rows:
            continue
        if carry is not None:  # 64-bit offsets: joined texts may pass 2 GB
            wide = pa.schema([pa.field(f.name, _WIDE.get(f.type, f.type)) for f in b.schema])
            both = pa.concat_tables([pa.Table.from_batches([x]).cast(wide) for x in (carry, b)])
            b = both.combine_chunks().to_batches()[0]
        at = changes(b, keys)
        if len(at) > 1:
            yield b.slice(0, int(at[-1])), at
            carry = b.slice(int(at[-1]))
        else:
            carry = b
    if carry is not None and carry.num_rows:
        yield carry, np.append(changes(carry, keys), carry.num_rows)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's connected component.

    ``edges`` (a, b: binary), either direction, written. Each round takes the smallest label
    among the neighbours and then that label's own label of the round before; labels and
    the check for changes stay in Spark, every round is written to the shared folder.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        # the neighbours' labels and the own one meet in one aggregation
        heard = (both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
                 .select(F.col("a").alias("node"), "l", F.lit(None).cast("binary").alias("old"))
                 .unionByName(labels.select("node", F.col("label").alias("l"), F.col("label").alias("old"))))
        step = heard.groupBy("node").agg(F.min("l").alias("label"), F.max("old").alias("old"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = written(step.join(far, "label", "left")
                       .select("node", "old", F.least("label", "far").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.filter(F.col("old") != F.col("label")).isEmpty():
            return labels
