"""Best-fit packing of token sequences by minimum bin slack.

Method. Each bin starts with the longest piece left; a subset-sum dynamic
programme over the lengths that are available (reachable sums as the bits of one
integer, each length as often as it is available) then finds the combination
that fills the bin most, which is removed. Pieces of one length are
interchangeable, so the search works on the histogram of lengths - at most
``capacity`` numbers, whatever the number of documents - and a combination is
removed as often as the histogram allows at once. The histogram is the only
thing the driver sees; the plan it makes (``capacity`` lengths x a few ranges of
ranks) is bounded by the capacity too.

Spark's part. One pass tokenizes whole texts, cuts them and numbers the pieces of
each length within their partition; the pieces are written once. Start ranks per
(partition, length) come from a window over the per-partition counts, never over
the pieces, so a length that a third of all pieces have is no hot group. Each
piece then looks its place up from its rank.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StructField, StructType)

from .runtime import prepare, written

CAPACITY = 1024


# --- the plan, on the histogram of lengths ------------------------------------

def fullest(counts: dict[int, int], order: list[int], room: int) -> dict[int, int]:
    """Lengths (with multiplicity) whose sum is the largest up to ``room``.

    ``order``: available lengths, longest first; sums reached with few long pieces
    are preferred. Bit s of ``reach`` is set if the sum s can be made.
    """
    reach, mask, want = 1, (1 << (room + 1)) - 1, 1 << room
    steps: list[tuple[int, int, int]] = []  # reach before, length, copies at once
    for size in order:
        if size > room:
            continue
        left, copies = min(counts[size], room // size), 1
        while left and not reach & want:  # 1, 2, 4, ... copies make any number of them
            take = min(copies, left)
            more = reach | (reach << (size * take)) & mask
            if more != reach:
                steps.append((reach, size, take))
                reach = more
            left -= take
            copies *= 2
        if reach & want:
            break
    total, used = reach.bit_length() - 1, {}
    for before, size, take in reversed(steps):
        if not before >> total & 1:
            used[size] = used.get(size, 0) + take
            total -= size * take
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges of ranks: (length, first rank, ranks, first bin, per bin, offset).

    The pieces of a length with ranks first..first + ranks - 1 lie ``per bin`` in
    each bin from ``first bin`` on, side by side from ``offset``.
    """
    counts = {k: n for k, n in histogram.items() if n > 0}
    if any(k < 1 or k > capacity for k in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    taken = dict.fromkeys(counts, 0)
    order = sorted(counts, reverse=True)
    out, bins = [], 0
    while order:
        longest = order[0]
        counts[longest] -= 1
        rest = order if counts[longest] else order[1:]
        used = fullest(counts, rest, capacity - longest)
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in used.items())
        offset = 0
        for size in sorted(used, reverse=True):
            n = used[size]
            out.append((size, taken[size], n * times, bins, n, offset))
            taken[size] += n * times
            counts[size] -= n * times
            offset += n * size
        bins += times
        order = [k for k in order if counts[k]]
    return out


# --- tokens ---------------------------------------------------------------------

@lru_cache(maxsize=2)
def load(path: str):
    """Byte-level BPE of a ``tokenizers`` file; gives the same ids, several times faster.

    Merging by the ids of merged tokens is what this kind of file describes when its
    merges are listed in the order of their ids, which is checked here. The file's added
    tokens are known to it; whether their strings inside a text count is said per call.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    if any(t[k] for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")) \
            or any(a != b and a.startswith(b) for a in special for b in special):
        raise ValueError("added tokens that are not found as plain strings")
    vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    if any(x >= y for x, y in zip(ids, ids[1:])):
        raise ValueError("merges are not in the order of their ids")
    # bytes are written as printable characters: themselves, or 256 and up in order
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain}
    back |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in back.values())}
    ranks = {bytes(back[c] for c in t): i for t, i in vocab.items()}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def borders(n: int, capacity: int) -> list[int]:
    """Where a document of n tokens is cut: all pieces full, the first may be shorter."""
    first = n - (n - 1) // capacity * capacity
    return [0, *range(first, n + 1, capacity)]


_PIECE = StructType([
    StructField("doc_id", LongType()), StructField("piece", IntegerType()),
    StructField("start", LongType()), StructField("length", LongType()),
    StructField("ids_crc32", LongType()), StructField("part", IntegerType()),
    StructField("nth", LongType())])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 2,
                 with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Pieces of all texts: doc_id, piece, start, length, ids_crc32 (and ids).

    ``part`` and ``nth`` number the pieces of a length within a partition. A null or
    empty text is the end id alone. Repeated rows are further documents. With
    ``added_tokens``, the string of an added token inside a text is that token, as the
    library reads it by default; else it is ordinary text (``encode_special_tokens``).
    """
    prepare(docs.sparkSession)
    schema = StructType([*_PIECE.fields, StructField("ids", ArrayType(IntegerType()))]) \
        if with_ids else _PIECE

    def run(batches):
        enc = load(tokenizer_path)
        allowed = enc.special_tokens_set if added_tokens else set()
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            cols = [[] for _ in schema.fields]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.encode_to_numpy(text.as_py() or "", allowed_special=allowed, disallowed_special=())
                n = len(ids) + 1
                raw = ids.astype("<u4").tobytes() + end_id.to_bytes(4, "little")
                cut = borders(n, capacity)
                for k, (lo, hi) in enumerate(zip(cut, cut[1:])):
                    row = (doc, k, lo, hi - lo, zlib.crc32(raw[4 * lo:4 * hi]), part, seen[hi - lo])
                    seen[hi - lo] += 1
                    for c, v in zip(cols, row):
                        c.append(v)
                    if with_ids:
                        cols[-1].append(np.frombuffer(raw[4 * lo:4 * hi], "<i4"))
                    if len(cols[0]) >= 8192:
                        yield _batch(cols, schema)
                        cols = [[] for _ in schema.fields]
            yield _batch(cols, schema)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}


def _batch(cols, schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[f.dataType.simpleString()]) for c, f in zip(cols, schema.fields)],
        names=schema.names)


# --- assignment -------------------------------------------------------------------

def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with length, part, nth; written, so that both reads agree) packed.

    Adds sequence_id and offset. An empty table stays empty.
    """
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges = sorted(plan(histogram, capacity))
    arr = np.array(ranges, np.int64).reshape(-1, 6)
    # one sorted key for (length, rank): ranks stay below 2 ** 50
    keys = arr[:, 0] * (1 << 50) + arr[:, 1]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(F.col("length").alias("_length"), F.col("part").alias("_part"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    ranked = (pieces.join(first, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part")))
              .withColumn("_rank", F.col("_first") + F.col("nth"))
              .drop("_length", "_part", "_first", "part", "nth"))
    keep = [f for f in ranked.schema.fields if f.name != "_rank"]
    schema = StructType([*keep, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches):
        for b in batches:
            size = b.column("length").to_numpy()
            rank = b.column("_rank").to_numpy()
            r = arr[np.searchsorted(keys, size * (1 << 50) + rank, side="right") - 1]
            at = rank - r[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in keep), pa.array(r[:, 3] + at // r[:, 4]),
                 pa.array(r[:, 5] + at % r[:, 4] * size)], names=schema.names)
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 2,
                   with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """All documents cut and packed into sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset;
    further input columns are ignored, a null doc_id stays null. ``added_tokens`` as in
    ``token_pieces``; the query and the pipeline ask for it.
    """
    pieces = written(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids, added_tokens), "pieces")
    return assign(pieces, capacity)
