"""Quality rules: word rules per document, and line frequency across documents.

Method. Lines are normalised (words joined by one blank, ASCII letters folded) and
hashed; per host (the ``source`` column, null counts as the empty name) each line's
distinct documents are counted, equal texts being one document. A line found in
more than ``max(LINE_FLOOR, LINE_SHARE percent of the host's documents)`` of them is
boilerplate and is removed. A document is rejected when it fails the word rules or
is depleted: less than ``KEEP_SHARE`` percent of its words are left.

Counting pre-aggregates: (host, line, document) triples are made distinct first and
then counted with partial sums, so a line that a third of all documents hold is no
hot group. Flagged lines are few per host (at most 100 / LINE_SHARE times the mean
number of lines of a document); they are written, and the join back to the texts is
a broadcast only if the planner's size limit allows it for the written table.

Words are runs of characters outside ASCII white space; texts are read whole. Null
texts count as empty (no words: rejected); null ids stay null; repeated rows give a
row each; columns beyond those of documents are kept by ``apply_rules``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from .runtime import Shield, prepare, written
from .words import U, mix, slices, windows

MIN_WORDS, MAX_REPEAT, WINDOW = 10, 20, 5
LINE_FLOOR, LINE_SHARE, KEEP_SHARE = 20, 2, 30

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(mask), offsets))


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if not len(key):
        return np.zeros(0, bool)
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    at = np.minimum(np.searchsorted(twice, key), max(len(twice) - 1, 0))
    return twice[at] == key if len(twice) else np.zeros(len(key), bool)


def _line_words(s, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word borders of each line."""
    return np.searchsorted(s.starts, starts), np.searchsorted(s.starts, ends)


def _line_hashes(s, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of each line's words in order, for lines with a word (words lo..hi)."""
    h = s.hashes()
    with np.errstate(over="ignore"):
        place = np.arange(len(h)) - np.repeat(lo, hi - lo)
        total = np.add.reduceat(mix(h + place.astype(U) * U(0x9E3779B97F4A7C15)), lo)
        return mix(total + (hi - lo).astype(U))


def lines_of(s) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lines with a word: start, end, first word, last word + 1, text; and whether any."""
    ls, le, lp = s.lines()
    lo, hi = _line_words(s, ls, le)
    full = np.flatnonzero(hi > lo)
    return ls[full], le[full], lo[full], hi[full], np.searchsorted(lp, full, side="right") - 1, full


def base_counts(s) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text of a slice."""
    n, d = len(s), s.data
    first_byte = (d & 0xC0) != 0x80
    blank = (d == 32) | ((d >= 9) & (d <= 13))
    ls, le, _, _, of, _ = lines_of(s)
    key = mix(s.span_hashes(ls, le) + mix(of.astype(U) + U(1)))
    distinct = np.unique(key)
    again = np.bincount(of, minlength=n)
    if len(distinct) < len(key):
        _, first = np.unique(key, return_index=True)
        again = again - np.bincount(of[first], minlength=n)
    else:
        again = np.zeros(n, np.int64)
    h = s.hashes()
    w, wp = windows(h, s.ptr, WINDOW)
    text = np.repeat(np.arange(n), np.diff(wp))
    twice = np.flatnonzero(_repeated(mix(w + mix(text.astype(U) + U(1)))))
    edge = np.zeros(len(h) + 1, np.int64)
    first_word = s.ptr[text[twice]] + twice - wp[text[twice]]
    np.add.at(edge, first_word, 1)
    np.add.at(edge, first_word + WINDOW, -1)
    covered = edge.cumsum()[:-1] > 0
    repeat = np.bincount(s.text_of_word()[covered], minlength=n)
    return (s.n_words, _count(first_byte & ~blank, s.offsets), _count(_SYMBOL[d], s.offsets), again, repeat)


def line_keys(col: pa.Array) -> list[np.ndarray]:
    """Distinct hashes of the normalised lines of each text."""
    out = []
    for s in slices(col, _FOLD):
        _, _, lo, hi, of, _ = lines_of(s)
        h = _line_hashes(s, lo, hi) if len(lo) else np.zeros(0, U)
        cut = np.searchsorted(of, np.arange(len(s) + 1))
        out += [np.unique(h[a:b]).view(np.int64) for a, b in zip(cut, cut[1:])]
    return out


def frequent_lines(docs: DataFrame) -> DataFrame:
    """(host, flagged): the hashes of the lines above the limit, one row per host, written."""
    def run(batches):
        for b in batches:
            keys = line_keys(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("host"), b.column("document"), pa.array(keys, pa.list_(pa.int64()))],
                names=["host", "document", "lines"])
    lines = (docs.select(F.coalesce("source", F.lit("")).alias("host"), "text",
                         F.xxhash64("text").alias("document"))
             .select("host", "document", "text")
             .mapInArrow(run, "host string, document long, lines array<long>"))
    pairs = lines.select("host", "document", F.explode_outer("lines").alias("line")).distinct()
    counts = pairs.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    sizes = (docs.select(F.coalesce("source", F.lit("")).alias("host"), F.xxhash64("text").alias("document"))
             .distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents")))
    limit = F.greatest(F.lit(LINE_FLOOR * 100), F.col("documents") * LINE_SHARE)
    flagged = (counts.filter((F.col("n") > LINE_FLOOR) & F.col("line").isNotNull())
               .join(sizes, "host").filter(F.col("n") * 100 > limit)
               .groupBy("host").agg(F.sort_array(F.collect_set("line")).alias("flagged")))
    return written(flagged, "lines")


_OUT = [StructField("n_words", LongType()), StructField("word_chars", LongType()),
        StructField("n_symbols", LongType()), StructField("n_dup_lines", LongType()),
        StructField("n_repeat_words", LongType()), StructField("base_failed", BooleanType()),
        StructField("left_words", LongType()), StructField("kept", BooleanType())]


def judge(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``docs`` (with text, source) with the rule columns, optionally with ``left_text``.

    ``left_text`` is the text without its flagged lines, the other lines unchanged. The
    input's own ``text`` column is kept only if ``with_text``. Input columns named like a
    column of the result are replaced.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("left_text", "_host", "flagged", *[f.name for f in _OUT])
    flagged = frequent_lines(docs).withColumnRenamed("host", "_host")
    joined = (docs.join(flagged, F.coalesce("source", F.lit("")) == F.col("_host"), "left"))
    keep = [f for f in docs.schema.fields if with_text or f.name != "text"]
    schema = StructType([*keep, *_OUT, *([StructField("left_text", StringType())] if with_text else [])])

    def run(batches):
        for b in batches:
            host_lines, hosts = b.column("flagged"), b.column("_host").to_pylist()
            known: dict[str, np.ndarray] = {}
            parts, texts = [], []
            for raw, fold in zip(slices(b.column("text")), slices(b.column("text"), _FOLD)):
                base = base_counts(raw)
                left = base[0].copy()
                ls, le, lo, hi, of, _ = lines_of(fold)
                drop = np.zeros(len(lo), bool)
                if len(lo):
                    h = _line_hashes(fold, lo, hi).view(np.int64)
                    cut = np.searchsorted(of, np.arange(len(fold) + 1))
                    for k, (a, z) in enumerate(zip(cut, cut[1:])):
                        host = hosts[raw.first + k]
                        if z > a and host is not None:
                            bad = known.get(host)
                            if bad is None:
                                bad = known[host] = host_lines[raw.first + k].values.to_numpy()
                            drop[a:z] = np.isin(h[a:z], bad)
                    left -= np.bincount(of[drop], (hi - lo)[drop], len(fold)).astype(np.int64)
                parts.append((*base, left))
                if with_text:
                    texts += _without(raw, ls, le, of, drop)
            n, chars, symbols, dup, repeat, left = (
                np.concatenate(c).astype(np.int64) if parts else np.zeros(0, np.int64)
                for c in (zip(*parts) if parts else [()] * 6))
            failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT * n)
            kept = ~failed & (100 * left >= KEEP_SHARE * n)
            cols = [pa.array(c) for c in (n, chars, symbols, dup, repeat, failed, left, kept)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in keep), *cols,
                 *([pa.array(texts, pa.string())] if with_text else [])], names=schema.names)
    return joined.mapInArrow(run, schema)


def _without(s, ls, le, of, drop) -> list[str]:
    """The texts of a slice without the dropped lines and the newline after each."""
    out, cut = [], np.searchsorted(of, np.arange(len(s) + 1))
    for k, (a, z) in enumerate(zip(cut, cut[1:])):
        raw = s.data[s.offsets[k]:s.offsets[k + 1]].tobytes()
        bad = np.flatnonzero(drop[a:z]) + a
        if len(bad):
            at, parts = 0, []
            for j in bad:
                lo, hi = ls[j] - s.offsets[k], le[j] - s.offsets[k]
                parts.append(raw[at:lo])
                at = hi + 1
            parts.append(raw[at:])
            raw = b"".join(parts)
        out.append(raw.decode("utf-8", "replace"))
    return out


def rules(docs: DataFrame) -> DataFrame:
    """The rule columns of every document row."""
    return judge(docs.select("doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "left_words")


def apply_rules(docs: DataFrame) -> DataFrame:
    """Kept documents with their flagged lines removed; the columns of ``docs``.

    ``n_chars``, if there, follows the new text where lines were removed.
    """
    shield = Shield(docs, "source")
    out = judge(shield.inner, with_text=True).filter("kept")
    changed = F.col("left_words") < F.col("n_words")
    return shield.restore(out, F.when(changed, F.col("left_text")).otherwise(F.col("text")), changed)
