"""Approximate nearest neighbours by cross-polytope hashing, reranked exactly.

Method. A table rotates unit vectors by three rounds of random signs and a fast
Hadamard transform (padded to a power of two) and assigns them to the nearest signed
axis, which is its bucket. Queries probe, in each table, the buckets whose axes are nearest to them. Candidates of a bucket are scored
with the exact cosine in double precision, and the best of all tables are kept.

The number of probes is chosen on a bounded sample (``SAMPLE`` vectors by a hash of
the id) by brute force so that recall there reaches ``TARGET``; the sample is
thinner than the table, its neighbours are further away, so recall over the whole
table is higher. The rule is the same for tables of any size.

Spark's part. Rows and probes of a bucket meet in a cogroup whose groups are bounded:
buckets with more than ``BLOCK`` rows or ``QUERY_BLOCK`` probes are dealt to blocks by
a hash of the id, and each block of probes meets each block of rows. Queries that
found too few candidates are searched against all rows in blocks (exact way).

Vectors that are null, zero, or hold null or non-finite components, and rows without
an id, take no part; of repeated ids the smallest vector does. Vectors meet only
those of their own dimension.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import prepare, written

TABLES, SAMPLE, TARGET = 8, 4096, 0.97
BLOCK, QUERY_BLOCK = 4096, 2048
PROBES = (4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)
TOP, EVERY = 5, 50


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, embedding as doubles): one valid vector per id."""
    v = F.transform(vec_col, lambda x: x.cast("double"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) \
        & F.exists(v, lambda x: x != 0)
    return (vectors.filter(F.col(id_col).isNotNull() & F.coalesce(good, F.lit(False)))
            .groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(v).alias("embedding")))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotated(x: np.ndarray, table: int, which: int) -> np.ndarray:
    """Signed axes' scores of unit vectors: 2 x (padded dimension) columns."""
    n, d = x.shape
    size = 1 << max(1, (d - 1).bit_length())
    y = np.zeros((n, size))
    y[:, :d] = x
    rng = np.random.default_rng([d, table, which, 20240301])
    for _ in range(3):
        y = y * rng.choice([-1.0, 1.0], size)
        h = 1
        while h < size:
            y = y.reshape(n, -1, 2, h)
            y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, size)
            h *= 2
        y /= np.sqrt(size)
    return np.concatenate([y, -y], axis=1)


def buckets(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` best buckets of each unit vector in a table, best first."""
    total, code = None, None
    for which in range(hashes):
        s = rotated(x, table, which)
        width = s.shape[1]
        top = np.argsort(-s, axis=1, kind="stable")[:, :probes]
        val = np.take_along_axis(s, top, 1)
        if total is None:
            total, code = val, top
        else:  # best sums of one axis of each rotation
            total = (total[:, :, None] + val[:, None, :]).reshape(len(x), -1)
            code = (code[:, :, None] * width + top[:, None, :]).reshape(len(x), -1)
            best = np.argsort(-total, axis=1, kind="stable")[:, :probes]
            total, code = np.take_along_axis(total, best, 1), np.take_along_axis(code, best, 1)
    return code


def settings(sample: np.ndarray, top: int = TOP) -> tuple[int, int]:
    """(hashes, probes) for vectors of one dimension, from a bounded sample."""
    x = unit(sample)
    q = x[: max(1, min(len(x), 256))]
    cos = q @ x.T
    cos[np.arange(len(q)), np.arange(len(q))] = -2
    k = min(top, len(x) - 1)
    width = 2 << max(1, (sample.shape[1] - 1).bit_length())
    if k < 1:
        return 1, width
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    for probes in itertools.chain(PROBES, [width]):
        if probes > width:
            continue
        hit = np.zeros(near.shape, bool)
        for t in range(TABLES):
            own = buckets(x, t, 1, 1)[:, 0]
            hit |= (own[near][:, :, None] == buckets(q, t, 1, probes)[:, None, :]).any(axis=2)
        if hit.mean() >= TARGET:
            return 1, probes
    return 1, width


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _by_dimension(batch, at: int):
    """(rows, matrix) for each dimension in a batch."""
    col = batch.column(at)
    sizes = col.value_lengths().to_numpy()
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, _matrix(col.take(pa.array(rows)), int(d))


def _hashed(vectors: DataFrame, plan: dict[int, tuple[int, int]], probing: bool) -> DataFrame:
    """(dim, bucket, vec_id, raw): a row per table (and probe)."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            for d, rows, x in _by_dimension(b, 1):
                hashes, probes = plan[d]
                u = unit(x)
                raw = [r.tobytes() for r in x]
                for t in range(TABLES):
                    codes = buckets(u, t, hashes, probes if probing else 1) * TABLES + t
                    n = codes.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows) * n, d, np.int32)), pa.array(codes.ravel()),
                         pa.array(np.repeat(ids[rows], n)),
                         pa.array([r for r in raw for _ in range(n)], pa.binary())],
                        names=["dim", "bucket", "vec_id", "raw"])
    return vectors.mapInArrow(run, "dim int, bucket long, vec_id long, raw binary")


def _best(top: int):
    def run(key, rows: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                              "score": pd.Series(dtype="float64")})
        if rows.empty or probes.empty:
            return empty
        d = int(key[0])
        x = np.frombuffer(b"".join(rows["raw"]), np.float64).reshape(-1, d)
        q = np.frombuffer(b"".join(probes["raw"]), np.float64).reshape(-1, d)
        xs, qs = np.abs(x).max(axis=1), np.abs(q).max(axis=1)  # scaled: squares cannot overflow
        x, q = x / xs[:, None], q / qs[:, None]
        xn, qn = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        xi, qi = rows["vec_id"].to_numpy(), probes["vec_id"].to_numpy()
        out = []
        for k in range(0, len(q), 256):
            cos = (q[k:k + 256] @ x.T) / xn / qn[k:k + 256, None]
            cos[qi[k:k + 256, None] == xi[None, :]] = -9
            cut = np.partition(cos, max(0, len(xi) - top), axis=1)[:, max(0, len(xi) - top)]
            a, b = np.nonzero((cos >= cut[:, None] - 1e-9) & (cos > -2))
            # the same order of additions for every pair, so equal vectors tie exactly
            score = (q[k + a] * x[b]).sum(axis=1) / (qn[k + a] * xn[b])
            order = np.lexsort((xi[b], -score, a))
            a, b, score = a[order], b[order], score[order]
            first = np.searchsorted(a, a)
            keep = np.arange(len(a)) - first < top
            out.append(pd.DataFrame({"query_id": qi[k + a[keep]], "vec_id": xi[b[keep]], "score": score[keep]}))
        return pd.concat(out) if out else empty
    return run


def _meet(rows: DataFrame, probes: DataFrame, top: int) -> DataFrame:
    """Best ``top`` rows for the probes of each bucket, in bounded blocks."""
    key = ["dim", "bucket"]
    n = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("nx"))
         .join(probes.groupBy(*key).agg(F.count(F.lit(1)).alias("nq")), key)
         .select(*key, F.ceil(F.col("nx") / BLOCK).cast("int").alias("bx"),
                 F.ceil(F.col("nq") / QUERY_BLOCK).cast("int").alias("bq")))
    deal = lambda by: F.pmod(F.xxhash64("vec_id"), F.col(by)).cast("int")
    spread = lambda by: F.explode(F.sequence(F.lit(0), F.col(by) - 1))
    left = rows.join(n, key).withColumn("x", deal("bx")).withColumn("q", spread("bq"))
    right = probes.join(n, key).withColumn("q", deal("bq")).withColumn("x", spread("bx"))
    cols = [*key, "x", "q"]
    return (left.select(*cols, "vec_id", "raw").groupBy(*cols)
            .cogroup(right.select(*cols, "vec_id", "raw").groupBy(*cols))
            .applyInPandas(_best(top), "query_id long, vec_id long, score double"))


def _ranked(found: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, top: int = TOP, every: int = EVERY, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of each row with id % every = 0.

    Ties go to the smaller id. An empty table gives no rows.
    """
    prepare(vectors.sparkSession)
    base = written(usable(vectors, id_col, vec_col), "vectors")
    sizes = {r["d"]: r["n"] for r in
             base.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = {}
    for d in sizes:
        some = (base.filter(F.size("embedding") == d).orderBy(F.xxhash64("vec_id"), "vec_id")
                .limit(SAMPLE).select("embedding").collect())  # bounded sample
        plan[d] = settings(np.array([r["embedding"] for r in some], np.float64).reshape(-1, d), top)
    queries = base.filter(F.col("vec_id") % every == 0)
    found = written(_ranked(_meet(_hashed(base, plan, False), _hashed(queries, plan, True), top), top), "near")
    # the exact way for queries with too few candidates: all rows of their dimension, in blocks
    short = (queries.join(found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n")),
                          "vec_id", "left")
             .filter(F.coalesce("n", F.lit(0)) < F.least(F.lit(top), F.lit(max(sizes.values(), default=0) - 1)))
             .select("vec_id", "embedding"))
    if short.isEmpty():
        return found
    exact = {d: (0, 1) for d in sizes}
    rest = _meet(_whole(base, exact), _whole(short, exact), top)
    return _ranked(found.select("query_id", "vec_id", "score").union(rest), top)


def _whole(vectors: DataFrame, dims) -> DataFrame:
    """All vectors in one bucket per dimension, which ``_meet`` deals to blocks."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            for d, rows, x in _by_dimension(b, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), d, np.int32)), pa.array(np.zeros(len(rows), np.int64)),
                     pa.array(ids[rows]), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["dim", "bucket", "vec_id", "raw"])
    return vectors.mapInArrow(run, "dim int, bucket long, vec_id long, raw binary")
