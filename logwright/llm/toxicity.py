"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the words (ASCII letters folded, ASCII punctuation as
blanks), their stems (first 4, 5 and 6 bytes, which inflected forms share), pairs of
neighbours and pairs one word apart, hashed to 2**20 places; each place counts once
per text. FTRL-proximal keeps a learning rate per
coordinate and, through L1, leaves most weights at exactly zero: the model is a
short list of (place, weight) that goes to the workers with the scoring function.

Fitting uses a bounded sample: ``labels.SAMPLE`` documents, their whole texts. In the order of a
hash of the id they are dealt to groups of equal shares of feature bytes, as many as keep
each near ``SHARD_BYTES`` (a document has 4 MB of features at most); every group
runs FTRL over its part and the weights are averaged. Scoring reads every whole text
once. Scores depend on the text alone.

Nulls: a null text is an empty text (its score is that of no feature); null ids are
scored and never held out. Repeated rows give a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import labels as L
from .runtime import prepare, written
from .words import U, mix, slices

BITS, EPOCHS = 20, 5
#: Feature bytes of one fitting group, and what a document counts besides its features.
SHARD_BYTES, ROW_BYTES = 48 << 20, 64
STEMS = (4, 5, 6)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
THRESHOLD = 0.3

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _FOLD[_c] = 32


def features(s) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every word, stem, n-gram and skip-gram of a slice, repeats included."""
    h, group = s.hashes(), s.text_of_word()
    with np.errstate(over="ignore"):
        parts, of = [mix(h ^ U(1))], [group]
        for size in STEMS:
            longer = np.flatnonzero(s.ends - s.starts > size)
            stem = s.span_hashes(s.starts[longer], s.starts[longer] + size)
            parts.append(mix(stem ^ U(size)))
            of.append(group[longer])
        for gap, step in ((1, U(0x9E3779B97F4A7C15)), (2, U(0xC2B2AE3D27D4EB4F))):
            inner = group[gap:] == group[:-gap]
            parts.append(mix(h[:-gap] * step + h[gap:])[inner])
            of.append(group[gap:][inner])
    return np.concatenate(of), (np.concatenate(parts) >> U(64 - BITS)).astype(np.int64)


def ftrl(texts: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (place 2**BITS is the intercept) after ``EPOCHS`` passes: places, weights."""
    size = (1 << BITS) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(texts)):
            i = np.append(texts[k], size - 1)
            l1 = np.full(len(i), L1)
            l1[-1] = 0.0
            zi, ni = z[i], n[i]
            wi = np.where(np.abs(zi) <= l1, 0.0,
                          -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(wi.sum(), -30, 30)))
            g = p - y[k]
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[i] = ni + g * g
    l1 = np.full(size, L1)
    l1[-1] = 0.0
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    at = np.flatnonzero(w)
    return at, w[at]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, rest: int = 2,
          bound: int = L.SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights), sorted by place, fitted on at most ``bound`` labelled documents.

    Of repeated rows of an id the text with the smallest hash is taken. Without labelled
    documents the list is empty and every score is 0.5.
    """
    prepare(docs.sparkSession)
    ids = L.sample_ids(labels, label, modulus, rest, bound, docs)  # bounded: may be broadcast
    chosen = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
              .withColumn("order", F.coalesce(F.xxhash64("text"), F.lit(0))))

    def places(batches):
        for b in batches:
            out = []
            for s in slices(b.column("text"), _FOLD):
                of, at = features(s)
                key = np.unique(of * (1 << BITS) + at)
                cut = np.searchsorted(key, np.arange(len(s) + 1) * (1 << BITS))
                key = (key & ((1 << BITS) - 1)).astype("<i4")
                out += [key[a:z].tobytes() for a, z in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), b.column("order"), pa.array(out, pa.binary())],
                names=["doc_id", "y", "order", "x"])

    def run(pdf):
        pdf = pdf.sort_values("doc_id")
        at, w = ftrl([np.frombuffer(x, "<i4") for x in pdf["x"]], pdf["y"].to_numpy(np.float64))
        return type(pdf)({"place": at, "weight": w})

    sample = written(chosen.select("doc_id", "text", "y", "order")
                     .mapInArrow(places, "doc_id long, y int, order long, x binary")
                     .groupBy("doc_id").agg(F.min_by("y", "order").alias("y"), F.min_by("x", "order").alias("x"))
                     .withColumn("bytes", F.length("x") + ROW_BYTES), "toxicity-sample")
    total = sample.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    # at most ``bound`` rows of an id and a size
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    share = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) * shards / F.lit(max(total, 1)))
    dealt = sample.select("doc_id", "bytes").select("doc_id", share.alias("shard"))
    rows = (sample.join(F.broadcast(dealt), "doc_id")
            .groupBy("shard").applyInPandas(run, "place long, weight double")
            .groupBy("place").agg((F.sum("weight") / F.lit(shards)).alias("weight"))
            .orderBy("place").collect())  # bounded: at most 2**BITS places, L1 leaves few
    return (np.array([r["place"] for r in rows], np.int64),
            np.array([r["weight"] for r in rows], np.float64))


def score_batch(col: pa.Array, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    dense = np.zeros((1 << BITS) + 1, np.float32)
    dense[at] = weight
    bias = float(dense[-1])
    out = [np.zeros(0)]
    for s in slices(col, _FOLD):
        of, place = features(s)
        hit = np.flatnonzero(dense[place])
        key = np.unique(of[hit] * (1 << BITS) + place[hit])  # a place counts once per text
        raw = np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], len(s)) + bias
        out.append(1 / (1 + np.exp(-np.clip(raw, -500, 500))))
    return np.concatenate(out)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text, in place of any ``out``."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    prepare(docs.sparkSession)
    docs = docs.drop(out)

    def run(batches):
        for b in batches:
            yield b.append_column(out, pa.array(score_batch(b.column("text"), *model), pa.float64()))
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document row."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", L.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
