"""Substring dedup with difference-cover anchors.

A window is ``length`` (13) consecutive words of one document; each word covered by a
window whose word sequence also starts in a document with a smaller id is removed,
judged on the input. Words are runs of characters outside ASCII white space.

Method. D is a difference cover of the period p: any two positions have a common shift
below p that takes both into D modulo p. Anchors are runs of ``length - p + 1`` words
that start at positions in D modulo p, 3 of 7 positions here. Two equal windows
therefore hold an equal anchor at the same place. Only anchors are compared across
the corpus; where an anchor occurs in two documents or more, the windows around it are
its extensions, and only these are compared as a whole (128 bits). A window whose
smallest document is another one is covered.

Spark's part. A task decides the anchors and windows that it meets in a second document
before the exchange (``_Seen``): such rows are dealt evenly, and by its hash goes about one row
of a key and task, so a passage that very many documents share makes no large task. The
rest is dealt by hash and sorted within the partition; a scan with one row of memory
finds the runs, without groups in memory and without pairs. Exact copies of a text are found
first, in the same way by digest, and take no part: all their windows also start in the
first copy. Texts are shuffled once, by id, and that exchange is used by every pass. What a task
decides early depends on the order of its rows, so they are sorted first: a task that runs
again after a loss deals the same rows.

Null texts have no words. Rows without an id remove nothing and lose nothing. Repeated
rows of an id each give a row; an id removes nothing from its own rows. Texts shorter
than a window stay whole. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import combinations, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from .runtime import Shield, prepare, written
from .words import slices, windows

LENGTH = 13


@lru_cache(maxsize=8)
def cover(period: int) -> tuple[int, ...]:
    """Smallest difference cover of a period (first in lexicographic order)."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            d = (0, *rest)
            if len({(a - b) % period for a in d for b in d}) == period:
                return d
    raise ValueError("period must be positive")


def shape(length: int) -> tuple[int, int]:
    """(period, words of an anchor) for windows of a length."""
    period = min(7, (length + 1) // 2)
    return period, length - period + 1


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """(a, doc_id, done): hashes at the cover positions of every text; done: known to be shared."""
    period, size = shape(length)
    member = np.zeros(period, bool)
    member[list(cover(period))] = True

    def run(batches):
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for s in slices(b.column("text")):
                a, ptr = windows(s.hashes(), s.ptr, size)
                if not len(a):
                    continue
                text = np.repeat(np.arange(len(s)), np.diff(ptr))
                at = np.flatnonzero(member[(np.arange(len(a)) - ptr[text]) % period])
                # texts without a whole window cannot match
                at = at[s.n_words[text[at]] >= length]
                yield pa.RecordBatch.from_arrays(
                    [_signed(a[at]), pa.array(ids[s.first + text[at]])], names=["a", "doc_id"])
    ordered = docs.sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(_early(_gathered(run), "share"), "a long, doc_id long, done boolean")


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    """First row of each run of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


#: Slots of a task's table of keys, as a power of two: 9 MB whatever the data.
SEEN = 18


class _Seen:
    """Keys that a task has met, each with one of its documents, in a fixed number of slots.

    A key without a slot is only dealt by its hash again: what is decided here is never more
    than the exchange would have found, and every key goes through the exchange at least once.
    """

    def __init__(self):
        n = 1 << SEEN
        self.a, self.b, self.doc = (np.zeros(n, np.int64) for _ in range(3))
        # told: the slot's document was given as one of a shared key; hot: met again lately
        self.used, self.told, self.hot = (np.zeros(n, bool) for _ in range(3))

    def _has(self, slot, a, b):
        return self.used[slot] & (self.a[slot] == a) & (self.b[slot] == b)

    def split(self, a, b, d, rule: str):
        """((a, b, doc) to deal by hash, (a, b, doc) decided) of a batch of keys (a, b).

        ``rule``: "share" decides every document of a key that another one has too, "later"
        those that are not the key's smallest one.
        """
        order = np.lexsort((d, b, a))
        order = order[_starts([a[order], b[order], d[order]])]  # a row of each key and document
        a, b, d = a[order], b[order], d[order]
        start = _starts([a, b])
        size = np.diff(np.append(start, len(a)))
        ka, kb, least, most = a[start], b[start], d[start], d[start + size - 1]
        slot = ka & ((1 << SEEN) - 1)
        old = self._has(slot, ka, kb)
        was = np.where(old, self.doc[slot], least)
        if rule == "share":
            lead, share = was, (least != was) | (most != was)
            row = d != np.repeat(lead, size)
            former, deal = share & ~(old & self.told[slot]), ~old
        else:
            lead, share = np.minimum(was, least), np.zeros(len(start), bool)
            row = d > np.repeat(lead, size)
            former, deal = least < was, ~old | (least < was)
        done = [np.concatenate([x[row], y[former]]) for x, y in ((a, ka), (b, kb), (d, was))]
        self._keep(slot, ka, kb, lead, share, size > 1, old)
        return (ka[deal], kb[deal], least[deal]), done

    def _keep(self, slot, a, b, doc, told, again, old):
        held = self.used[slot] & self.hot[slot]
        new = np.flatnonzero(~old & ~held)
        at = slot[new]
        self.a[at], self.b[at], self.doc[at] = a[new], b[new], doc[new]
        self.told[at], self.hot[at], self.used[at] = told[new], again[new], True
        self.hot[slot[~old & held]] = False  # a second chance
        same = np.flatnonzero(old & self._has(slot, a, b))
        at = slot[same]
        self.doc[at], self.hot[at] = doc[same], True
        self.told[at] |= told[same]


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    return _runs(keys) if len(keys[0]) else np.zeros(0, np.int64)


def _early(run, rule: str):
    """The batches of a function with ``done``: rows that :class:`_Seen` has decided."""
    def split(batches):
        seen = _Seen()
        for t in run(batches):
            a, d = t.column("a").to_numpy(), t.column("doc_id").to_numpy()
            two = "b" in t.schema.names
            b = t.column("b").to_numpy() if two else np.zeros(len(a), np.int64)
            deal, done = seen.split(a, b, d, rule)
            ka, kb, doc = (pa.array(np.concatenate(x)) for x in zip(deal, done))
            flag = pa.array(np.arange(len(ka)) >= len(deal[0]))
            names = ["a", *["b"] * two, "doc_id", "done"]
            yield pa.RecordBatch.from_arrays([ka, *[kb] * two, doc, flag], names=names)
    return split


def _dealt(found: DataFrame, *key: str) -> DataFrame:
    """Rows to decide by their key's hash, decided ones evenly; sorted, the decided ones last."""
    deal = F.when(F.col("done"), F.xxhash64("doc_id", "a")).otherwise(F.col("a"))
    return found.repartition(deal).sortWithinPartitions("done", *key, "doc_id")


def _undecided(batches):
    """(rows to decide, decided rows) of each batch that has rows."""
    for t in batches:
        if t.num_rows:
            n = t.num_rows - int(np.count_nonzero(t.column("done").to_numpy(zero_copy_only=False)))
            yield t.slice(0, n), t.slice(n)


def shared_anchors(found: DataFrame) -> DataFrame:
    """(doc_id, a) of the anchors that two documents or more have; rows may repeat."""
    def run(batches):
        key = doc = None  # the last run so far and its first document
        many = False
        for b, decided in _undecided(batches):
            if decided.num_rows:
                yield decided.select(["doc_id", "a"])
            if not b.num_rows:
                continue
            k, d = b.column("a").to_numpy(), b.column("doc_id").to_numpy()
            start = _runs([k])
            size = np.diff(np.append(start, len(k)))
            first = d[start].copy()
            old = key is not None and k[0] == key
            if old:
                first[0] = doc
            share = d[start + size - 1] != first
            if old:
                if share[0] and not many:  # the run's first document waited for a second one
                    yield pa.RecordBatch.from_arrays([pa.array([doc]), pa.array([key])], names=["doc_id", "a"])
                share[0] |= many
            keep = np.repeat(share, size)
            yield pa.RecordBatch.from_arrays([pa.array(d[keep]), pa.array(k[keep])], names=["doc_id", "a"])
            key, doc, many = k[-1], first[-1], bool(share[-1])
    return _dealt(found, "a").mapInArrow(run, "doc_id long, a long")


def extensions(docs: DataFrame, length: int) -> DataFrame:
    """(a, b, doc_id, done): hashes of the windows that hold a shared anchor; done: known to be covered.

    ``docs``: doc_id, text, shared (the anchors of the text that others have, or null).
    """
    period, size = shape(length)
    member = np.zeros(period, bool)
    member[list(cover(period))] = True

    def run(batches):
        for b in batches:
            ids, known = b.column("doc_id").to_numpy(), b.column("shared")
            have = np.flatnonzero(known.is_valid().to_numpy(zero_copy_only=False))
            if not len(have):
                continue
            known = known.take(pa.array(have))
            flat, off = known.flatten().to_numpy(), np.concatenate([[0], np.cumsum(known.value_lengths().to_numpy())])
            for s in slices(b.column("text").take(pa.array(have))):
                h = s.hashes()
                a, ap = windows(h, s.ptr, size)
                w, wp = windows(h, s.ptr, length)
                v, _ = windows(h, s.ptr, length, seed=2)
                a = a.view(np.int64)
                for k in range(len(s)):
                    lo, hi, n = ap[k], ap[k + 1], wp[k + 1] - wp[k]
                    if n <= 0:
                        continue
                    row = s.first + k
                    hit = np.flatnonzero(np.isin(a[lo:hi], flat[off[row]:off[row + 1]])
                                         & member[np.arange(hi - lo) % period])
                    edge = np.zeros(n + period + 1, np.int64)  # windows i with i <= anchor < i + period
                    np.add.at(edge, np.maximum(hit - period + 1, 0), 1)
                    np.add.at(edge, hit + 1, -1)
                    at = np.flatnonzero(edge.cumsum()[:n] > 0) + wp[k]
                    if not len(at):
                        continue
                    _, one = np.unique(w[at], return_index=True)
                    at = at[one]
                    yield pa.RecordBatch.from_arrays(
                        [_signed(w[at]), _signed(v[at]), pa.array(np.full(len(at), ids[have[row]]))],
                        names=["a", "b", "doc_id"])
    ordered = docs.sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(_early(_gathered(run), "later"), _ROWS)


_ROWS = "a long, b long, doc_id long, done boolean"


def _gathered(run, rows: int = 50_000):
    """The batches of a function, joined into batches of about ``rows`` rows."""
    def joined(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return joined


def covered(found: DataFrame) -> DataFrame:
    """(doc_id, a) of the rows whose (a, b) a smaller id has too; rows may repeat."""
    def run(batches):
        last = None  # (a, b, smallest document) of the last run so far
        for t, decided in _undecided(batches):
            if decided.num_rows:
                yield decided.select(["doc_id", "a"])
            if not t.num_rows:
                continue
            a, b, d = (t.column(k).to_numpy() for k in ("a", "b", "doc_id"))
            start = _runs([a, b])
            first = d[start].copy()
            if last is not None and (a[0], b[0]) == last[:2]:
                first[0] = last[2]
            keep = d > np.repeat(first, np.diff(np.append(start, len(d))))
            yield pa.RecordBatch.from_arrays([pa.array(d[keep]), pa.array(a[keep])], names=["doc_id", "a"])
            last = (a[-1], b[-1], first[-1])
    return _dealt(found, "a", "b").mapInArrow(run, "doc_id long, a long")


def _copies(texts: DataFrame) -> DataFrame:
    """(doc_id, marks): marks of the texts that a smaller id has too."""
    half = lambda at: F.conv(F.substring("m", at, 15), 16, 10).cast("long")
    marks = (texts.filter(F.col("text").isNotNull()).select("doc_id", F.md5("text").alias("m"))
             .select(half(1).alias("a"), half(16).alias("b"), F.col("doc_id").cast("long").alias("doc_id"))
             .sortWithinPartitions("a", "b", "doc_id"))
    found = marks.mapInArrow(_early(lambda batches: (b for b in batches if b.num_rows), "later"), _ROWS)
    return written(covered(found).groupBy("doc_id").agg(F.collect_set("a").alias("marks")), "copies")


def _removed(docs: DataFrame, length: int, *carry: str) -> DataFrame:
    """doc_id, text, gone (hashes of covered windows, or null), copy: every row.

    Columns to ``carry`` go through every pass, so that all passes read the same exchange.
    """
    cols = ["doc_id", "text", *carry]
    texts = docs.select(*cols).filter(F.col("doc_id").isNotNull())
    # copies of a text: every one but those of its smallest id (an id may have several texts)
    copies = _copies(texts)
    mark = F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long")
    is_copy = F.coalesce(F.array_contains("marks", mark), F.lit(False))
    by_id = texts.repartition("doc_id")
    take_part = by_id.join(copies, "doc_id", "left").filter(~is_copy).select(*cols)
    shared = (shared_anchors(anchors(take_part, length))
              .groupBy("doc_id").agg(F.collect_list("a").alias("shared")))
    around = by_id.join(shared, "doc_id", "left").select(*cols, "shared")
    gone = covered(extensions(around, length)).groupBy("doc_id").agg(F.collect_list("a").alias("gone"))
    alone = docs.filter(F.col("doc_id").isNull()).select(
        *cols, F.lit(None).cast("array<long>").alias("gone"), F.lit(False).alias("copy"))
    return (by_id.join(gone, "doc_id", "left").join(copies, "doc_id", "left")
            .select(*cols, "gone", is_copy.alias("copy")).unionByName(alone))


def _masks(batch: pa.RecordBatch, length: int):
    """(row, words' starts, ends, kept words) of each text of a batch."""
    gone, copy = batch.column("gone"), batch.column("copy").to_pylist()
    valid = gone.is_valid().to_numpy(zero_copy_only=False)
    for s in slices(batch.column("text")):
        need = any(valid[s.first:s.first + len(s)])
        w, wp = windows(s.hashes(), s.ptr, length) if need else (None, None)
        for k in range(len(s)):
            row, n = s.first + k, int(s.ptr[k + 1] - s.ptr[k])
            kept = None
            if copy[row] and n >= length:
                kept = np.zeros(n, bool)
            elif valid[row] and n >= length:
                bad = np.flatnonzero(np.isin(w[wp[k]:wp[k + 1]].view(np.int64), gone[row].values.to_numpy()))
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, bad, 1)
                np.add.at(edge, bad + length, -1)
                kept = edge.cumsum()[:n] == 0
            yield row, s, k, n, kept


def dedup_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document row."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            n_words, n_removed, sha = [], [], []
            for row, s, k, n, kept in _masks(b, length):
                words = s.data[s.offsets[k]:s.offsets[k + 1]].tobytes().split()
                if kept is not None:
                    words = list(compress(words, kept.tolist()))
                n_words.append(n)
                n_removed.append(n - len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return _removed(docs, length).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _cut(s, k: int, kept: np.ndarray) -> bytes:
    """The kept words of a text with the white space between them; around a removed part
    one newline stays if it held one, else one blank."""
    parts, last = [], None
    at = np.flatnonzero(kept) + s.ptr[k]
    for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []:
        lo, hi = int(s.starts[run[0]]), int(s.ends[run[-1]])
        if last is not None:
            parts.append(b"\n" if 10 in s.data[last:lo] else b" ")
        parts.append(s.data[lo:hi].tobytes())
        last = hi
    return b"".join(parts)


def apply_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without the repeated parts; documents that lose every word go.

    ``n_chars``, if there, follows the new text. Other columns stay as they are, and so
    does the text of a document that loses nothing.
    """
    prepare(docs.sparkSession)
    shield = Shield(docs, "doc_id")
    schema = StructType([shield.inner.schema["row"], StructField("text", StringType()),
                         StructField("changed", BooleanType())])

    def run(batches):
        for b in batches:
            rows, texts, changed, old = [], [], [], b.column("text")
            for row, s, k, n, kept in _masks(b, length):
                if kept is None or kept.all():
                    rows.append(row)
                    texts.append(old[row].as_py())
                    changed.append(False)
                elif kept.any():
                    rows.append(row)
                    texts.append(_cut(s, k, kept).decode())
                    changed.append(True)
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(pa.array(rows, pa.int64())), pa.array(texts, pa.string()),
                 pa.array(changed, pa.bool_())], names=["row", "text", "changed"])
    out = _removed(shield.inner, length, "row").select("row", "text", "gone", "copy").mapInArrow(run, schema)
    return shield.restore(out, changed=F.col("changed"))
