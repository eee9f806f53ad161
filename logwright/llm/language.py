"""Language identification: nearest of several centroids per language, by cosine.

A text becomes a vector of ``PLACES`` hashed byte n-grams (1 to 4 bytes of the text with
ASCII letters folded and every run of other ASCII characters as one blank), weighted
by (1 + log of the count) x inverse document frequency and normalised to length one.
Each language's sample vectors are clustered into up to ``CENTROIDS`` groups by
spherical k-means; a text takes the language of
the centroid with the largest cosine (ties: the smaller name), and that cosine, from
0 to 1, is its score. Rejection is by distance: a text further from its centroid
than all but ``REJECT`` of the centroid's own members is marked ``rejected``; a text
without a letter is at distance one from everything and is always ``und``.

Fitting uses at most ``SAMPLE`` rows a language, chosen by a hash of id and text; rows
above a hash limit computed from the language's row count are left out before anything
is shuffled, so a language that holds most rows is no hot group. Inverse document
frequencies and clusters are computed in Spark, one bounded group a language. The driver
sees one count a place and the centroids (at most ``LANGUAGES`` x ``CENTROIDS`` of 32 KB;
more languages are an error, never dropped). Scoring reads every whole text once, without
a shuffle, in pieces of bounded size.

Nulls and edges: null texts, empty texts and texts without a letter (Unicode category L) are
``und`` with score 0, and so is every text when nothing could be learned; null ids are
scored, learned from and never held out; rows with a null language are not learned from;
repeated rows give a row each and count once in the sample; an empty table gives
none. Columns other than doc_id, text and lang are not read, so they cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import labels as L
from .runtime import prepare, written
from .words import text_buffers

UNKNOWN = "und"
BITS, GRAMS = 13, (1, 2, 3, 4)
PLACES = 1 << BITS
CENTROIDS, ROUNDS, SAMPLE, LANGUAGES = 4, 12, 2_000, 400
#: Rows that a centroid stands for at least, where a language has more.
MEMBERS = 10
#: Share of a centroid's members that lie beyond its rejection distance.
REJECT = 0.005
#: Texts and bytes of one counting step.
TEXTS, PIECE = 64, 1 << 20

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOG = np.log(np.maximum(np.arange(1 << 12), 1)).astype(np.float32)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a letter (Unicode category L)."""
    def any_of(mask):
        return np.diff(np.searchsorted(np.flatnonzero(mask), offsets)) > 0
    out = any_of(_ASCII_LETTER[data])
    for k in np.flatnonzero(~out & any_of(data > 127)):
        text = data[offsets[k]:offsets[k + 1]].tobytes().decode("utf-8", "replace")
        out[k] = any(c.isalpha() for c in text)
    return out


def squeezed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with one blank for each run of other ASCII characters, and text borders."""
    d = _FOLD[data]
    keep = np.ones(len(d), bool)
    keep[1:] = (d[1:] != 32) | (d[:-1] != 32)
    first = offsets[:-1][np.diff(offsets) > 0]
    keep[first] = True
    return d[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Occurrences of each place in each text: text x ``PLACES`` + place is the index."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n) * PLACES, np.diff(offsets))
    out = None
    longest = max(GRAMS)
    for a in range(0, len(data), PIECE):
        part = data[a:a + PIECE + longest - 1].astype(np.uint32)
        text = row[a:a + len(part)]
        gram, keys = np.zeros(len(part), np.uint32), []
        for size in range(1, longest + 1):
            gram = gram[:len(part) - size + 1] | part[size - 1:] << np.uint32(8 * (size - 1))
            if size not in GRAMS or not len(gram):
                continue
            m = min(len(gram), PIECE)  # the bytes beyond belong to the next piece
            place = (gram[:m] + np.uint32(size)) * np.uint32(2654435761) ^ np.uint32(size * 0x27D4EB2F)
            place = (place * np.uint32(2246822519)) >> np.uint32(32 - BITS)
            last = text[size - 1:size - 1 + m]
            key = last + place
            keys.append(key if text[0] == last[-1] else key[text[:m] == last])
        c = np.bincount(np.concatenate(keys), minlength=n * PLACES)
        out = c if out is None else out + c
    return np.zeros(n * PLACES, np.int64) if out is None else out


def steps(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(data, borders) of consecutive texts of a column, at most ``TEXTS`` of about ``PIECE`` bytes."""
    data, off = text_buffers(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + PIECE, side="right")) - 1
        j = min(max(i + 1, j), i + TEXTS, n)
        yield data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def frequencies(col: pa.Array) -> Iterator[np.ndarray]:
    """1 + log(count) of each place, per text; zero rows for texts without a letter."""
    for data, off in steps(col):
        c = counts(*squeezed(data, off))
        at = np.flatnonzero(c)
        out = np.zeros(len(c), np.float32)
        out[at] = 1 + _LOG[np.minimum(c[at], len(_LOG) - 1)]
        more = at[c[at] >= len(_LOG)]
        out[more] = 1 + np.log(c[more])
        out = out.reshape(-1, PLACES)
        out[~has_letter(data, off)] = 0
        yield out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one (zero rows stay)."""
    size = np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64))
    return x / np.where(size > 0, size, 1).astype(x.dtype)[:, None]


def clusters(x: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` unit centroids of unit rows, and the centroid of each row.

    The search starts from rows spread evenly over the order of nearness to the mean, so
    no choice is random; groups below ``MEMBERS`` rows give their rows to the others.
    """
    rank = np.argsort(x @ unit(x.mean(0, keepdims=True))[0], kind="stable")
    c = x[rank[(2 * np.arange(k) + 1) * len(x) // (2 * k)]]
    for _ in range(rounds):
        of = (x @ c.T).argmax(1)
        size = np.bincount(of, minlength=len(c))
        used = np.flatnonzero(size >= min(MEMBERS, size.max()))
        c = unit(np.array([x[of == j].sum(0) for j in used]))
    return c, (x @ c.T).argmax(1)


@dataclass
class Model:
    """Centroids (rows, sorted by language), their rejection limits, and the place weights."""
    langs: list
    centroids: np.ndarray
    limits: np.ndarray
    idf: np.ndarray

    def judge(self, col: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """Language, cosine and whether rejected, for each text of a column."""
        langs, score, rejected = [], [np.zeros(0)], [np.zeros(0, bool)]
        for tf in frequencies(col):
            known = tf.any(1)
            if not self.langs:
                langs += [UNKNOWN] * len(tf)
                score.append(np.zeros(len(tf)))
                rejected.append(np.ones(len(tf), bool))
                continue
            sim = np.clip(unit(tf * self.idf) @ self.centroids.T, 0, 1)
            best = sim.argmax(1)
            top = np.round(sim[np.arange(len(sim)), best].astype(np.float64), 6)
            langs += [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            score.append(np.where(known, top, 0.0))
            rejected.append(~known | (top < self.limits[best]))
        return langs, np.concatenate(score), np.concatenate(rejected)


# --- Spark ------------------------------------------------------------------------

def _sample(docs: DataFrame, bound: int) -> DataFrame:
    """(doc_id, text, lang, order) of some more than ``bound`` rows a language (all, if fewer).

    Different rows are counted approximately; the limit allows for six times that error.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .withColumn("order", F.xxhash64("doc_id", "text").bitwiseAND((1 << 62) - 1))
    sizes = (known.groupBy("lang").agg(F.approx_count_distinct("order", 0.02).alias("n"))
             .limit(LANGUAGES + 1).collect())
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    limits = [(r["lang"], min(1.12 * (bound + 6 * bound ** 0.5) / r["n"], 1.0) * (1 << 62)) for r in sizes]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, most double")
    return (known.join(F.broadcast(limits), "lang")  # LANGUAGES rows at most
            .filter(F.col("order") <= F.col("most")).select("doc_id", "text", "lang", "order"))


def train(docs: DataFrame, modulus: int = 4, rest: int = 2, bound: int = SAMPLE) -> Model:
    """Centroids of at most ``bound`` rows a language outside the held-out ids."""
    prepare(docs.sparkSession)
    learned = docs.select("doc_id", "text", "lang").filter(~L.held_out(F.col("doc_id"), modulus, rest))

    def vectors(batches):
        for b in batches:
            tf = [np.zeros((0, PLACES), np.float32), *frequencies(b.column("text"))]
            rows = [r for t in tf for r in t]
            place = [np.flatnonzero(r).astype("<i4") for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), b.column("order"), b.column("doc_id"),
                 pa.array([p.tobytes() for p in place], pa.binary()),
                 pa.array([r[p].tobytes() for r, p in zip(rows, place)], pa.binary())],
                names=["lang", "order", "doc_id", "place", "tf"])
    rows = (_sample(learned, bound)
            .mapInArrow(vectors, "lang string, order long, doc_id long, place binary, tf binary")
            .filter(F.length("place") > 0)
            .dropDuplicates(["lang", "order", "doc_id", "place", "tf"]))
    first = Window.partitionBy("lang").orderBy("order", "doc_id", "place", "tf")
    # at most LANGUAGES x bound sparse vectors
    rows = written(rows.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= bound), "language-sample")

    def document_counts(batches):
        total, n = np.zeros(PLACES, np.int64), 0
        for b in batches:
            for p in b.column("place").to_pylist():
                total[np.frombuffer(p, "<i4")] += 1
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int32()), pa.array([*total[at], n], pa.int64())],
                                         names=["place", "n"])
    df = np.zeros(PLACES + 1)
    for r in rows.select("place").mapInArrow(document_counts, "place int, n long").groupBy("place").sum("n").collect():
        df[r[0]] = r[1]  # the last entry: rows
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32)

    def group(pdf):
        pdf = pdf.sort_values("k")
        x = np.zeros((len(pdf), PLACES), np.float32)
        for r, p, t in zip(x, pdf["place"], pdf["tf"]):
            r[np.frombuffer(p, "<i4")] = np.frombuffer(t, np.float32)
        x = unit(x * idf)
        x = x[x.any(1)]
        if not len(x):
            return type(pdf)({"lang": [], "cluster": [], "limit": [], "centroid": []})
        c, of = clusters(x)
        near = np.einsum("ij,ij->i", x, c[of])
        out = [(pdf["lang"].iloc[0], j, float(np.quantile(near[of == j], REJECT)), v.astype("<f4").tobytes())
               for j, v in enumerate(c) if (of == j).any()]
        return type(pdf)(dict(zip(["lang", "cluster", "limit", "centroid"], zip(*out))))
    fitted = (rows.groupBy("lang").applyInPandas(group, "lang string, cluster int, limit double, centroid binary")
              .orderBy("lang", "cluster").collect())
    return Model([r["lang"] for r in fitted],
                 np.array([np.frombuffer(r["centroid"], "<f4") for r in fitted], np.float32).reshape(-1, PLACES),
                 np.array([r["limit"] for r in fitted]), idf)


def identify(docs: DataFrame, model: Model, unknown: str | None = None) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every document row.

    ``unknown``: the name that rejected texts get instead of their nearest language.
    """
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            langs, score, rejected = model.judge(b.column("text"))
            if unknown is not None:
                langs = [unknown if r else v for v, r in zip(langs, rejected)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "rejected"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")


def classify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document row."""
    out = identify(docs, train(docs))
    return out.select("doc_id", L.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "rejected")
