"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from one vectorised pass over whole texts (``statistics``). The
trees are fitted on a bounded sample of labelled documents (``labels.SAMPLE``
rows x the statistics, as bins of one byte: half a megabyte) and flattened into
arrays (feature, threshold, children, value), so that scoring a batch is one
numpy gather per tree level. Scores depend on the text alone.

Nulls: a null text is an empty text; null ids are scored and never held out.
Repeated rows give a row each. Without usable labels, or with one class only,
every score is the smoothed share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labels as L
from .runtime import prepare
from .words import U, mix, slices

BINS, TREES, DEPTH, RATE, L2, LEAF = 64, 80, 4, 0.15, 1.0, 8.0
THRESHOLD = 0.3

NAMES = ("chars", "words", "mean_word", "long_words", "one_letter_words", "upper", "digits", "symbols",
         "bars", "stops", "commas", "exclaims", "non_ascii", "lines", "mean_line", "dup_lines",
         "distinct_words", "top_word", "repeat_pairs", "word_tail_symbols", "blank")


def _class(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_SYMBOL, _UPPER = _class("#*$%&|<>"), _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT, _BLANK = _class("0123456789"), _class(" \t\n\v\f\r")


def _per(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags between successive borders."""
    at = np.flatnonzero(mask)
    return np.diff(np.searchsorted(at, offsets)).astype(np.float64)


def _distinct(group: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group: number of different hashes, and how often the commonest occurs."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    # the group in the high bits keeps groups apart; 40 bits of hash tell words of one text apart
    key = np.sort((group.astype(U) << U(40)) | (h >> U(24)))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    of = (key[new] >> U(40)).astype(np.int64)
    runs = np.diff(np.concatenate([new, [len(key)]]))
    top = np.zeros(n)
    np.maximum.at(top, of, runs)
    return np.bincount(of, minlength=n).astype(np.float64), top


def statistics(col: pa.Array) -> np.ndarray:
    """One row of statistics (``NAMES``) per text of a column."""
    parts = [np.zeros((0, len(NAMES)), np.float32)]
    for s in slices(col):
        n, d, off = len(s), s.data, s.offsets
        chars = _per((d & 0xC0) != 0x80, off)
        words = s.n_words.astype(np.float64)
        c, w = np.maximum(chars, 1), np.maximum(words, 1)
        size = s.ends - s.starts
        group = s.text_of_word()
        h = s.hashes()
        distinct, top = _distinct(group, h, n)
        inner = group[1:] == group[:-1]
        pairs = mix(h[:-1] * U(0x9E3779B97F4A7C15) + h[1:])[inner]
        different_pairs, _ = _distinct(group[1:][inner], pairs, n)
        ls, le, lp = s.lines()
        full = np.flatnonzero(le > ls)
        line_of = np.searchsorted(lp, full, side="right") - 1
        lines = np.bincount(line_of, minlength=n).astype(np.float64)
        different, _ = _distinct(line_of, s.span_hashes(ls[full], le[full]), n)
        tail = _SYMBOL[d[s.ends - 1]] if len(d) else np.zeros(0, bool)
        count = lambda m: np.bincount(group[m], minlength=n)
        parts.append(np.column_stack([
            chars, words, _per(~_BLANK[d] & ((d & 0xC0) != 0x80), off) / w, count(size > 15) / w,
            count(size == 1) / w, _per(_UPPER[d], off) / c, _per(_DIGIT[d], off) / c,
            _per(_SYMBOL[d], off) / c, _per(d == 124, off) / w, _per(d == 46, off) / w,
            _per(d == 44, off) / w, _per(d == 33, off) / w, _per(d >= 0xC0, off) / c, lines,
            words / np.maximum(lines, 1), 1 - different / np.maximum(lines, 1), distinct / w, top / w,
            1 - different_pairs / np.maximum(words - 1, 1), count(tail) / w, _per(_BLANK[d], off) / c,
        ]).astype(np.float32))
    return np.concatenate(parts)


# --- boosted trees ----------------------------------------------------------------

@dataclass
class Trees:
    """Flattened trees: node arrays of all trees, the root of each, and the prior."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        raw = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):  # a leaf is its own child
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            raw += self.value[node]
        return 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic boosting on binned statistics, level by level."""
    n, f = x.shape if len(x) else (0, len(NAMES))
    share = (y.sum() + 0.5) / (n + 1) if n else 0.5
    empty = Trees(*(np.zeros(0, t) for t in (int, np.float32, int, int, float, int)), DEPTH,
                  float(np.log(share / (1 - share))))
    if n == 0 or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
            for j in range(f)]
    binned = np.column_stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)])  # b: x <= cuts[b]
    flat = binned + np.arange(f) * BINS
    raw = np.full(n, empty.prior)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
        at = np.full(n, roots[-1])
        level = [roots[-1]]
        for depth in range(DEPTH + 1):
            slot = {v: k for k, v in enumerate(level)}
            index = np.full(len(nodes), -1)
            index[level] = range(len(level))
            live = np.flatnonzero(index[at] >= 0)
            k = index[at[live]]
            m = len(level)
            cells = (k[:, None] * (f * BINS) + flat[live]).ravel()
            g = np.bincount(cells, np.repeat(grad[live], f), m * f * BINS).reshape(m, f, BINS)
            h = np.bincount(cells, np.repeat(hess[live], f), m * f * BINS).reshape(m, f, BINS)
            gt, ht = g[:, 0].sum(1), h[:, 0].sum(1)
            for v, a, b in zip(level, gt, ht):
                nodes[v][4] = -RATE * a / (b + L2)
            if depth == DEPTH:
                break
            gl, hl = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
            gr, hr = gt[:, None, None] - gl, ht[:, None, None] - hl
            gain = gl ** 2 / (hl + L2) + gr ** 2 / (hr + L2) - (gt ** 2 / (ht + L2))[:, None, None]
            limit = np.array([len(c) for c in cuts])
            bad = (hl < LEAF / 4) | (hr < LEAF / 4) | (np.arange(BINS - 1) >= limit[:, None])[None]
            gain[bad] = -1
            nxt = []
            for v in level:
                j, b = np.unravel_index(gain[slot[v]].argmax(), gain[slot[v]].shape)
                if gain[slot[v], j, b] <= 1e-6:
                    continue
                nodes[v][:4] = [int(j), float(cuts[j][b]), len(nodes), len(nodes) + 1]
                for _ in range(2):
                    nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
                mine = live[at[live] == v]
                at[mine] = np.where(binned[mine, j] <= b, nodes[v][2], nodes[v][3])
                nxt += nodes[v][2:4]
            level = nxt
            if not level:
                break
        raw += np.array([v[4] for v in nodes])[at]
    a = list(zip(*nodes))
    return Trees(np.array(a[0]), np.array(a[1], np.float32), np.array(a[2]), np.array(a[3]),
                 np.array(a[4]), np.array(roots), DEPTH, empty.prior)


# --- Spark ------------------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, rest: int = 0,
          bound: int = L.SAMPLE) -> Trees:
    """Trees fitted on at most ``bound`` labelled documents outside the held-out rows.

    Of repeated rows of an id the text with the smallest hash is taken, so the sample
    stays bounded. Only its statistics reach the driver (at most bound x 21 numbers).
    """
    prepare(docs.sparkSession)
    ids = L.sample_ids(labels, label, modulus, rest, bound)  # bounded: may be broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")

    def run(batches):
        for b in batches:
            x = statistics(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), b.column("order"),
                 pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(NAMES)).cast(pa.list_(pa.float32()))],
                names=["doc_id", "y", "order", "x"])
    stats = (chosen.withColumn("order", F.coalesce(F.xxhash64("text"), F.lit(0)))
             .select("doc_id", "text", "y", "order")
             .mapInArrow(run, "doc_id long, y int, order long, x array<float>"))
    rows = (stats.groupBy("doc_id").agg(F.min_by("y", "order").alias("y"), F.min_by("x", "order").alias("x"))
            .orderBy("doc_id").collect())
    x = np.array([r["x"] for r in rows], np.float32).reshape(-1, len(NAMES))
    return fit(x, np.array([r["y"] for r in rows], np.float64))


def score(docs: DataFrame, model: Trees, out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text, in place of any ``out``."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    prepare(docs.sparkSession)
    docs = docs.drop(out)

    def run(batches):
        for b in batches:
            yield b.append_column(out, pa.array(model.score(statistics(b.column("text"))), pa.float64()))
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document row."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", L.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
