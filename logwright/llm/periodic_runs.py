"""Periodic runs of words, and texts without their repetitions.

A run is a stretch of words with smallest period q, at least ``max(MIN_WORDS, 3 q)`` words
long, that no neighbouring word extends with that period.

Method. A run of period p holds 2 p consecutive words that equal the word p places on,
so one of them lies on the grid of the multiples of 2 p: of all p together that are
n / 2 x (1 + 1/2 + 1/3 ...) comparisons (a harmonic sum), made as strided comparisons
of one array that holds the words of many texts. From a hit, the longest common
extensions (LCE) of both positions to the right and to the left give the run. They are
answered by difference-cover sampling: ``COVER`` is a perfect difference set modulo
``PERIOD``, so from any two positions some step below ``PERIOD`` leads to two sampled
ones. Only sampled suffixes are sorted (by doubling over block names, each ``PERIOD`` words);
few words are compared to reach synchronised samples, a sparse table over the sorted
samples' common prefixes gives the blocks they share, and at most ``PERIOD`` more words
settle the rest. A stretch found with several multiples of its period keeps the smallest. A hit
with fewer than ``NEAR`` equal words on either side cannot belong to a run, so texts without
near repetition are never sorted.

One pass over the texts, no shuffle. Memory follows one slice of texts (about 1 MB, at least
one whole text); hits are resolved in blocks of ``HITS``. Words are told apart by their
64-bit hashes mixed with the text's number, so no extension crosses a text border.

Nulls and edges: a null text has no words and no runs, nor has an empty one; null ids stay null;
repeated rows give a row each; an empty table gives none; of runs with the same
exponent the one that starts first, then the one with the smaller period, is the best. Only
``doc_id`` and ``text`` are read, so other columns cannot clash. Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import prepare
from .words import U, mix, slices

MIN_WORDS = 24
#: A perfect difference set: every residue modulo PERIOD is a difference of two members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Equal words beside a hit below which no run can hold it: a run has at least 16 positions
#: that equal the word a period on, so NEAR - 1 on either side are too few.
NEAR = 8
HITS = 1 << 18

RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, runs array<{RUN}>, best {RUN}, collapsed string"


def _steps() -> np.ndarray:
    """For two residues, the least step that leads both into the cover."""
    inside = np.isin(np.arange(PERIOD), COVER)
    r = np.arange(PERIOD)
    hits = np.array([inside[(r + d) % PERIOD] for d in range(PERIOD)])
    both = hits[:, :, None] & hits[:, None, :]
    assert both.any(0).all()
    return both.argmax(0)


STEPS = _steps()


class Extensions:
    """Longest common extensions to the right of any two positions of an array of words."""

    def __init__(self, words: np.ndarray):
        n = self.n = len(words)
        self.words = np.concatenate([words, np.zeros(2 * PERIOD, U)])  # no word has hash 0
        # sampled positions class by class, each up to one block that reaches past the end
        place = [np.arange(r, n + 1, PERIOD) for r in COVER]
        sample = np.concatenate(place)
        self.first = np.full(PERIOD, -1)
        self.first[list(COVER)] = np.concatenate([[0], np.cumsum([len(p) for p in place])])[:-1]
        names = np.zeros(len(sample), U)
        with np.errstate(over="ignore"):
            for k in range(PERIOD):
                names = mix(names + self.words[np.minimum(sample + k, n)] + U(k + 1))
            # a block that ends a class is like no other
            last = np.cumsum([len(p) for p in place])[[len(p) > 0 for p in place]] - 1
            names[last] = np.arange(1, len(last) + 1).astype(U)
        rank = np.unique(names, return_inverse=True)[1]
        levels, step, m = [rank], 1, len(sample)
        while m and rank.max() + 1 < m:  # prefix doubling over blocks
            after = np.zeros(m, np.int64)
            after[:-step] = rank[step:] + 1
            rank = np.unique(rank * (m + 1) + after, return_inverse=True)[1]
            levels.append(rank)
            step *= 2
        self.rank = rank
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        # common blocks of neighbours in sorted order, read off the doubling levels
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(m - 1, 0), np.int32)
        for k in range(len(levels) - 1, -1, -1):
            ok = np.flatnonzero((a < m) & (b < m))
            ok = ok[levels[k][a[ok]] == levels[k][b[ok]]]
            common[ok] += 1 << k
            a[ok] += 1 << k
            b[ok] += 1 << k
        self.table = [common]  # sparse table of minima
        while 2 ** len(self.table) <= len(common):
            half, t = 2 ** (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(t[:-half], t[half:]))

    def _blocks(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Blocks that the suffixes at two sampled positions (not the same) have in common."""
        x = self.rank[self.first[i % PERIOD] + i // PERIOD]
        y = self.rank[self.first[j % PERIOD] + j // PERIOD]
        lo, hi = np.minimum(x, y), np.maximum(x, y)  # minimum of common[lo:hi]
        level = np.frexp(hi - lo)[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = level == k
            t = self.table[k]
            out[at] = np.minimum(t[lo[at]], t[hi[at] - (1 << int(k))])
        return out

    def _walk(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most`` (up to ``PERIOD``) of them."""
        out = np.zeros(len(i), np.int64)
        live = np.flatnonzero(most > 0)
        for k in range(PERIOD):
            if not len(live):
                break
            a, b = i[live] + k, j[live] + k
            same = (np.maximum(a, b) < self.n)
            same &= self.words[np.minimum(a, self.n)] == self.words[np.minimum(b, self.n)]
            live = live[same]
            out[live] += 1
            live = live[most[live] > k + 1]
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from ``i`` and ``j`` on (i < j <= n)."""
        step = STEPS[i % PERIOD, j % PERIOD]
        out = self._walk(i, j, step)
        live = np.flatnonzero((out == step) & (j + step <= self.n))
        if len(live):
            a, b = i[live] + step[live], j[live] + step[live]
            blocks = self._blocks(a, b)
            a, b = a + blocks * PERIOD, b + blocks * PERIOD
            out[live] += blocks * PERIOD + self._walk(a, b, np.full(len(live), PERIOD))
        return out


def _near(words: np.ndarray, i: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Hits with at least NEAR equal words to the right (itself included) or to the left."""
    n = len(words)

    def walk(sign, first):
        live = np.arange(len(i))
        for k in range(first, first + NEAR):
            a = i[live] + sign * k
            b = a + p[live]
            ok = (a >= 0) & (b < n)
            ok &= words[np.clip(a, 0, n - 1)] == words[np.clip(b, 0, n - 1)]
            live = live[ok]
            if not len(live):
                break
        return live
    keep = np.zeros(len(i), bool)
    keep[walk(1, 0)] = True
    keep[walk(-1, 1)] = True
    return np.flatnonzero(keep)


def hits(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (position, period) on the harmonic grid with equal words and near repetition.

    ``longest``: words of the longest text in the array.
    """
    found_i, found_p, size = [], [], 0
    for p in range(1, longest // 3 + 1):
        at = np.flatnonzero(words[:-p:2 * p] == words[p::2 * p][:(len(words) - p + 2 * p - 1) // (2 * p)])
        if len(at):
            found_i.append(at * (2 * p))
            found_p.append(np.full(len(at), p))
            size += len(at)
        if size >= HITS or (p == longest // 3 and size):
            i, q = np.concatenate(found_i), np.concatenate(found_p)
            keep = _near(words, i, q)
            if len(keep):
                yield i[keep], q[keep]
            found_i, found_p, size = [], [], 0


def enumerate_runs(words: np.ndarray, ptr: np.ndarray) -> list[np.ndarray]:
    """(start, length, period) of every run of each text, by start, then period.

    ``words``: hashes of the words of consecutive texts; ``ptr``: their borders.
    """
    n = np.diff(ptr)
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(n)
    if not len(words) or n.max() < MIN_WORDS:
        return out
    text = np.repeat(np.arange(len(n)), n)
    with np.errstate(over="ignore"):  # words of different texts differ
        own = mix(words + text.astype(U) * U(0x9E3779B97F4A7C15)) | U(1)
    # texts without a hit hold no run; only the others are sorted, and searched again
    live = np.zeros(len(n), bool)
    for i, _ in hits(own, int(n.max())):
        live[text[i]] = True
    live = np.flatnonzero(live)
    if not len(live):
        return out
    size = n[live]
    start = np.concatenate([[0], np.cumsum(size)])
    chosen = own[np.repeat(ptr[live] - start[:-1], size) + np.arange(start[-1])]
    right, left = Extensions(chosen), Extensions(chosen[::-1])
    total = len(chosen)
    found = none
    for i, p in hits(chosen, int(size.max())):
        after = right.common(i, i + p)
        # to the left: the words before i + p and before i, in the reversed array
        before = left.common(total - i - p, total - i)
        length = before + after + p
        keep = length >= np.maximum(MIN_WORDS, 3 * p)
        rows = np.column_stack([i - before, length, p])[keep]
        found = np.concatenate([found, np.unique(rows, axis=0)])
    # stretches found with several periods keep the smallest
    order = np.lexsort((found[:, 2], found[:, 1], found[:, 0]))
    found = found[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[new]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    owner = np.searchsorted(start, found[:, 0], side="right") - 1
    cut = np.searchsorted(owner, np.arange(len(live) + 1))
    for k, t in enumerate(live.tolist()):
        rows = found[cut[k]:cut[k + 1]].copy()
        rows[:, 0] -= start[k]
        out[t] = rows
    return out


def repeated(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def best_run(runs: np.ndarray):
    """The run of greatest length / period (ties: smaller start, then period), or None."""
    if not len(runs):
        return None
    return max(runs.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


#: For a document's id and number of words: the word that stands in each place (None: as they are).
Order = Callable[[object, int], np.ndarray | None]


def runs_batch(ids: list, col: pa.Array, order: Order | None = None) -> Iterator[tuple]:
    """(runs, words kept joined by one blank) of each text of a column."""
    for s in slices(col):
        h = s.hashes()
        ptr = s.ptr
        sources = {}
        if order is not None:
            for k, n in enumerate(s.n_words.tolist()):
                source = order(ids[s.first + k], n)
                if source is not None:
                    sources[k] = source
                    h[ptr[k]:ptr[k + 1]] = h[ptr[k]:ptr[k + 1]][source]
        for k, runs in enumerate(enumerate_runs(h, ptr)):
            words = s.data[s.offsets[k]:s.offsets[k + 1]].tobytes().split()
            if k in sources:
                words = [words[j] for j in sources[k].tolist()]
            if len(runs):
                words = [words[j] for j in np.flatnonzero(~repeated(len(words), runs)).tolist()]
            yield runs, b" ".join(words)


def find_runs(docs: DataFrame, order: Order | None = None) -> DataFrame:
    """doc_id, runs, best and collapsed (the text without repetitions) of every document row."""
    prepare(docs.sparkSession)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def table(rows: np.ndarray) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], names=["start", "length", "period"])

    def run(batches):
        for b in batches:
            out = list(runs_batch(b.column("doc_id").to_pylist(), b.column("text"), order))
            runs = [r for r, _ in out]
            best = [best_run(r) for r in runs]
            border = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(border), table(flat)),
                 pa.array([r and dict(zip(("start", "length", "period"), r)) for r in best], run_type),
                 pa.array([t for _, t in out], pa.binary()).cast(pa.string())],
                names=["doc_id", "runs", "best", "collapsed"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def planted_tail(doc_id, n: int) -> np.ndarray | None:
    """Order of the words of a tenth of the documents: from one word on, a stretch repeats."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + np.arange(n - a) % p
    return out


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the best run, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    text = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    length, period = F.col("best.length"), F.col("best.period")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                        length.alias("length"), period.alias("period"),
                        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
