"""Vectorised words and word hashes over Arrow text columns.

A word is a maximal run of characters outside space, tab, newline, vertical
tab, form feed and carriage return (``[^\\x20\\x09-\\x0D]+``). These separators
are single bytes in UTF-8, so words are found on the raw bytes of a whole
column slice at once. A null text has no words.

Word hashes are 64-bit: a polynomial over per-byte random values (prefix sums,
so no loop over words), then a bit mixer. Words longer than ``LONG_WORD`` bytes
are hashed with BLAKE2b instead, which bounds the scratch memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text that one step looks at (a longer text makes a step of its own).
SLICE = 1 << 20
LONG_WORD = 1 << 16

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_pow: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _pow:
        size = SLICE + LONG_WORD + 1
        with np.errstate(over="ignore"):
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                p = np.empty(size, U)
                p[0] = 1
                k = 1
                while k < size:  # doubling: p[k:2k] = p[:k] * base**k
                    m = min(k, size - k)
                    p[k:k + m] = p[:m] * U(pow(base, k, 1 << 64))
                    k += m
                _pow.append(p)
    return _pow[0][:n], _pow[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (in a new array)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U(30))
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
    return x


class Slice:
    """Some texts of a batch: bytes, text borders, word borders."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, fold: np.ndarray | None):
        self.first = first  # row of the first text in the batch
        self.data = data if fold is None else fold[data]
        self.offsets = offsets  # n + 1 text borders
        n = len(data)
        inside = ~_SEP[self.data]
        starts = inside.copy()
        ends = inside.copy()
        if n:
            starts[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cut = offsets[(offsets > 0) & (offsets < n)]
            starts[cut] = inside[cut]
            ends[cut - 1] = inside[cut - 1]
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.ptr = np.searchsorted(self.starts, offsets)  # n + 1 word borders

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.ptr)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.n_words)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        return self.span_hashes(self.starts, self.ends)

    def span_hashes(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans that follow each other (words, lines)."""
        out = np.empty(len(s), U)
        long = np.flatnonzero(e - s > LONG_WORD)
        i = 0
        for stop in [*long.tolist(), len(s)]:
            while i < stop:  # spans i..j lie within SLICE + LONG_WORD bytes
                j = max(i + 1, int(np.searchsorted(s[i:stop], s[i] + SLICE)) + i)
                out[i:j] = self._short(s[i:j], e[i:j])
                i = j
            if stop < len(s):
                d = hashlib.blake2b(self.data[s[stop]:e[stop]].tobytes(), digest_size=8).digest()
                out[stop] = int.from_bytes(d, "little")
                i = stop + 1
        return out

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the newline-separated lines, and the line borders of each text.

        Every text has at least one line, so n newlines make n + 1 lines.
        """
        newline = np.flatnonzero(self.data == 10)
        before = np.searchsorted(newline, self.offsets)
        # each text: its start, then one after each newline
        starts = np.sort(np.concatenate([self.offsets[:-1], newline + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.offsets[1:], newline]), kind="stable")
        return starts, ends, before + np.arange(len(self.offsets))

    def _short(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        lo, hi = int(s[0]), int(e[-1])
        power, inverse = _powers(hi - lo + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(hi - lo + 1, U)
            np.cumsum(_BYTE[self.data[lo:hi]] * power[:-1], out=sums[1:])
            h = (sums[e - lo] - sums[s - lo]) * inverse[s - lo]
            h += (e - s).astype(U) * U(0xD6E8FEB86659FD93)
        return mix(h)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 borders of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[off[0]:off[-1]] if len(off) else data, off - off[0] if len(off) else np.zeros(1, np.int64)


def slices(col: pa.Array, fold: np.ndarray | None = None) -> Iterator[Slice]:
    """The texts of a column in slices of about ``SLICE`` bytes, whole texts each.

    ``fold``: optional 256-entry byte table applied first (case folding and so on).
    """
    data, off = text_buffers(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE, side="right")) - 1)
        j = min(j, n)
        yield Slice(i, data[off[i]:off[j]], off[i:j + 1] - off[i], fold)
        i = j


def windows(h: np.ndarray, ptr: np.ndarray, n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, and the run borders of each text.

    ``ptr`` are the word borders; texts with fewer than ``n`` words have no run.
    """
    count = np.maximum(np.diff(ptr) - n + 1, 0)
    out_ptr = np.concatenate([[0], np.cumsum(count)])
    total = len(h) - n + 1
    if total <= 0 or not out_ptr[-1]:
        return np.empty(0, U), np.zeros(len(ptr), np.int64)
    return mix(rolled(h, n, seed)[run_starts(ptr, n)]), out_ptr


def run_starts(ptr: np.ndarray, n: int) -> np.ndarray:
    """First word of every run of ``n`` words that stays within its text."""
    count = np.maximum(np.diff(ptr) - n + 1, 0)
    first = np.repeat(ptr[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return np.arange(int(count.sum())) + first


def rolled(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Unmixed hash of the ``n`` words from each word on, text borders ignored."""
    total = max(0, len(h) - n + 1)
    out = np.zeros(total, U)
    with np.errstate(over="ignore"):
        step = U((0xC2B2AE3D27D4EB4F * (2 * seed + 1)) % (1 << 64) | 1)
        for j in range(n):
            out *= step
            out += h[j:j + total]
    return out
