"""Bounded, documented samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents that a classifier is fitted on at most, the same at every size.
SAMPLE = 20_000


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    """Whether the id belongs to the rows that are never learned from; a null id does not."""
    return F.coalesce(remainder(doc_id, modulus) == F.lit(rest), F.lit(False))


def sample_ids(labels: DataFrame, label: str, modulus: int, rest: int, bound: int = SAMPLE,
               docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, y) of at most ``bound`` labelled documents outside the held-out rows.

    Chosen by a hash of the id, so that the sample is spread over the table and the same
    in every run. Repeated labels of an id count by their majority (a tie as 1); null
    labels and ids are left out, and with ``docs`` so are ids that no document has.
    """
    known = labels.select("doc_id", F.col(label).alias("y")).filter(
        F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id"), modulus, rest))
    votes = known.groupBy("doc_id").agg(F.avg("y").alias("y"))
    if docs is not None:
        votes = votes.join(docs.select("doc_id"), "doc_id", "left_semi")
    return (votes.select("doc_id", (F.col("y") >= 0.5).cast("int").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
