"""Structured Streaming ingest: new log files -> store batches.

The parse is stateless (one line in, zero or more rows out), so no watermark or
state store is needed. Each micro-batch is one load of the store under an id made
of the stream's name and the epoch: replaying an epoch after a failure adds
nothing. The caller names the checkpoint folder, so a restart goes on where the
stream stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parse as P


def run_to_store(spark: SparkSession, inputs: dict, root: str, checkpoint: str, name: str = "stream",
                 available_now: bool = False, max_files_per_trigger: int | None = None):
    """One stream over the folders of all known kinds, loading each epoch into the store.

    The kinds are unioned into a single streaming query so there is exactly one writer
    per store. With ``available_now`` the stream processes the files present now and
    stops. A micro-batch is read and parsed once, by the job that writes its rows; its line counts
    are those of its batch in ``store.read_stats``.
    """
    from ..sources.store import ingest

    def source(folder):
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(folder)
    streams = [source(inputs[k]).select("value", F.lit(k).alias("kind")) for k in inputs if k in P.KINDS]
    lines = streams[0]
    for st in streams[1:]:
        lines = lines.unionByName(st)

    def sink(batch: DataFrame, epoch: int) -> None:
        ingest(spark, batch, root, mode="append", batch=f"{name}-{epoch}")

    w = lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
