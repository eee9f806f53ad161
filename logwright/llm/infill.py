"""Fill-in-middle transformation by memoised content-defined chunks.

A token is a run of ASCII letters or one other character. A document of ``n`` tokens is
cut at two token borders drawn from a digest of its id, and written in the order
prefix-suffix-middle (psm), suffix-prefix-middle (spm) or unchanged (plain).

Method. A rolling hash over ``WINDOW`` bytes cuts each text into chunks whose borders
depend on the bytes around them only, so passages that documents share give the same
chunks. A chunk's boundary summary is its number of tokens and characters and whether
it begins and ends with a letter. Summaries are kept per Python worker in a cache of
bounded size whose keys are the chunks themselves: a hit is a comparison of content, never
of hashes alone. Chunk counts combine from left to right (a letter run across a
border is one token less), the sums locate the chunk of each cut, and only that chunk
is scanned. One pass over the texts, no shuffle; memory follows one Arrow batch (at least
one whole text) and the cache.

``restore`` rebuilds the text from output and form with DataFrame functions. Texts that
hold a mark stay plain, and no mark can begin inside another or inside a part, so the
marks of an output are the only ones.

Nulls and edges: a null text is an empty text, an empty text is plain with n = 0; a null id
is drawn from as the empty string; repeated rows give a row each; an empty table gives
none; only ``doc_id`` and ``text`` are read, so other columns cannot clash. Texts are
read whole, whatever their length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import prepare
from .words import slices

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of documents left plain, and of the others written suffix first.
PLAIN, SPM = 10, 20
#: Bytes the rolling hash sees; a chunk is 2**CUT_BITS bytes on average and MAX_CHUNK at most
#: (and up to three bytes more, so that no character is cut).
WINDOW, CUT_BITS, MAX_CHUNK = 16, 9, 4096
#: Bytes of chunks that one generation of a worker's cache holds (there are two).
CACHE_BYTES = 16 << 20

SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
          "output string")

_GEAR = np.random.default_rng(20250301).integers(0, 1 << 32, 256, dtype=np.uint32)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the chunks of consecutive texts (each text's first byte among them)."""
    h = _GEAR[data]
    step = 1
    while step < WINDOW:  # h[i] = sum of gear[data[i - j]] << j over step bytes, doubled
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    first = (data & 0xC0) != 0x80
    at = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    at = at[at < len(data)]
    text = np.searchsorted(offsets, at, side="right") - 1
    at = at[(at - offsets[text] >= WINDOW) & first[at]]  # the window lies in one text
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], at]))
    size = np.diff(np.append(starts, offsets[-1]))
    long = np.flatnonzero(size > MAX_CHUNK)
    if len(long):
        more = [np.arange(starts[k] + MAX_CHUNK, starts[k] + size[k], MAX_CHUNK) for k in long]
        more = np.concatenate(more)
        for _ in range(3):  # on to the next character
            inside = more < len(data)
            more[inside] += ~first[more[inside]]
        starts = np.unique(np.concatenate([starts, more[more < len(data)]]))
    return starts


def token_starts(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a token, when the bytes before them are no letter."""
    letter = _LETTER[data]
    out = (data & 0xC0) != 0x80
    out[1:] &= ~(letter[1:] & letter[:-1])
    return out


class Memo:
    """Boundary summaries by chunk content; two generations bound the bytes held."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size, self.new, self.old = limit, 0, {}, {}

    def get(self, chunk: bytes):
        found = self.new.get(chunk)
        if found is None and chunk in self.old:
            found = self.put(chunk, self.old[chunk])
        return found

    def put(self, chunk: bytes, summary: tuple) -> tuple:
        if self.size + len(chunk) > self.limit:
            self.old, self.new, self.size = self.new, {}, 0
        self.new[chunk] = summary
        self.size += len(chunk)
        return summary


def summaries(chunks: list[bytes], memo: Memo) -> np.ndarray:
    """(tokens, characters, begins with a letter, ends with one) of each chunk."""
    out = [memo.get(c) for c in chunks]
    missing = dict.fromkeys(c for c, s in zip(chunks, out) if s is None)
    if missing:
        data = np.frombuffer(b"".join(missing), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(c) for c in missing])])[:-1]
        starts = token_starts(data)
        letter = _LETTER[data]
        # a chunk's first byte is judged as if nothing came before it
        starts[at] = True
        last = np.append(at[1:], len(data)) - 1
        rows = zip(np.add.reduceat(starts.astype(np.int64), at).tolist(),
                   np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), at).tolist(),
                   letter[at].tolist(), letter[last].tolist())
        for c, row in zip(missing, rows):
            missing[c] = memo.put(c, row)
        out = [missing[c] if s is None else s for c, s in zip(chunks, out)]
    return np.array(out, np.int64).reshape(-1, 4)


class Located:
    """Token counts of the texts of a slice, and the place of any token border."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, memo: Memo):
        self.data, self.offsets = data, offsets
        self.starts = cuts(data, offsets)
        raw = data.tobytes()
        ends = np.append(self.starts[1:], len(data))
        s = summaries([raw[a:z] for a, z in zip(self.starts.tolist(), ends.tolist())], memo)
        # first chunk of each text; an empty text has none
        self.first = np.searchsorted(self.starts, offsets)
        joined = np.zeros(len(s), bool)
        if len(s) > 1:
            joined[1:] = (s[1:, 2] & s[:-1, 3]).astype(bool)
            joined[self.first[self.first < len(s)]] = False
        self.joined = joined
        self.tokens = np.concatenate([[0], np.cumsum(s[:, 0] - joined)])
        self.chars = np.concatenate([[0], np.cumsum(s[:, 1])])
        self.n = np.diff(self.tokens[self.first])

    def border(self, text: int, k: int) -> tuple[int, int]:
        """Byte and character, from the text's start, where its token ``k`` begins (n: its end)."""
        lo, hi = int(self.first[text]), int(self.first[text + 1])
        if k >= self.n[text]:
            return int(self.offsets[text + 1] - self.offsets[text]), int(self.chars[hi] - self.chars[lo])
        want = int(self.tokens[lo]) + k
        c = int(np.searchsorted(self.tokens, want, side="right")) - 1
        a = int(self.starts[c])
        z = int(self.starts[c + 1]) if c + 1 < len(self.starts) else len(self.data)
        chunk = self.data[a:z]
        begins = token_starts(chunk)
        begins[0] = not self.joined[c]
        at = int(np.flatnonzero(begins)[want - int(self.tokens[c])])
        chars = int(self.chars[c] - self.chars[lo]) + int(np.count_nonzero((chunk[:at] & 0xC0) != 0x80))
        return a + at - int(self.offsets[text]), chars


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers below 2**32 from the digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


_memo = Memo()  # of this worker process, for all its tasks


def transform_batch(ids: list, col: pa.Array, seed: int) -> list[list]:
    """n, form, prefix_chars, middle_chars and output of each text of a column."""
    n, form, prefix, middle, output = [], [], [], [], []
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    for s in slices(col):
        where = Located(s.data, s.offsets, _memo)
        for k in range(len(s)):
            text = s.data[s.offsets[k]:s.offsets[k + 1]].tobytes()
            total = int(where.n[k])
            h1, h2, h3, h4 = draws(ids[s.first + k], seed)
            n.append(total)
            if not text or h3 % 100 >= 100 - PLAIN or any(m in text for m in marks):
                form.append("plain")
                prefix.append(None)
                middle.append(None)
                output.append(text)
                continue
            (a, ac), (z, zc) = (where.border(k, c) for c in sorted((h1 % (total + 1), h2 % (total + 1))))
            parts = {PREFIX: text[:a], MIDDLE: text[a:z], SUFFIX: text[z:]}
            form.append("spm" if h4 % 100 < SPM else "psm")
            order = (SUFFIX, PREFIX, MIDDLE) if form[-1] == "spm" else (PREFIX, SUFFIX, MIDDLE)
            prefix.append(ac)
            middle.append(zc - ac)
            output.append(b"".join(m.encode() + parts[m] for m in order))
    return [n, form, prefix, middle, output]


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every document row."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            n, form, prefix, middle, output = transform_batch(b.column("doc_id").to_pylist(), b.column("text"), seed)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(output, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from."""
    rest = lambda c, part, mark: F.substr(c, F.length(part) + F.lit(len(mark) + 1))

    def parts(first: str, second: str):
        body = F.substr(output, F.lit(len(first) + 1))
        a = F.substring_index(body, second, 1)
        tail = rest(body, a, second)
        b = F.substring_index(tail, MIDDLE, 1)
        return a, b, rest(tail, b, MIDDLE)
    p, s, m = parts(PREFIX, SUFFIX)
    s2, p2, m2 = parts(SUFFIX, PREFIX)
    return (F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2))
            .otherwise(output))


def digests(formed: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts rebuilt from them, in place of the outputs."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                         digest(F.col("output")).alias("output_sha256"),
                         digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))
