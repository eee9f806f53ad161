"""N-gram Jaccard join: MinHash LSH forest, exact verification, groups.

Two documents are linked if the Jaccard similarity of their sets of five-word
shingles is at least 0.8. Words are runs of characters outside ASCII white space,
unchanged; a text of one to four words is one shingle.

Method.
1. One pass over whole texts makes, per document, a fingerprint of its shingles and
   ``TREES`` x ``DEPTH`` MinHash values (16 bits each). Documents with equal
   fingerprints are one class: copies are counted, never paired.
2. Each tree of the forest is the sorted list of its ``DEPTH``-value prefixes. Rows are
   dealt by tree and prefix and sorted within the partition - a sorted prefix trie - and a
   scan keeps the classes that share a node at the depth where the search ends.
3. The search starts at whole prefixes and shortens them level by level, tree by tree, until
   the target recall: a pair of similarity s that is looked for down to depth d(t) of tree t
   is missed with probability prod(1 - s**d(t)), and ``AT`` holds the first depths where a
   pair at the threshold itself is found with probability ``TARGET``, whatever else the
   table holds. Each pair is tested at the longest prefix it shares (the first such tree),
   and not again below: a node's unit leaves out the pairs of one child. Pairs whose
   estimate lies five standard deviations below the threshold are ruled out; of the rest
   only the local components are emitted, one row per class, so a group of n near copies
   makes n rows, not n**2. A node is dealt to blocks by a hash of the class, and each
   pair of blocks is a bounded unit of work.
4. The components of these candidates are verified: each is dealt to blocks (by classes and
   shingles) and each pair of blocks gets the texts once, whatever the number of trees that
   found its pairs. Every candidate pair is decided on the sets of shingles, whose
   intersections are products of 0/1 matrices; a class comes out once per unit, with its
   number of links and the first class of its links' component in the unit.
5. Connected components of the links are the groups.

Where only the groups matter (:func:`one_of_each`), prefixes shorten adaptively: at each
level a node whose classes are in one group already is done; in the others one class
of each group meets the node's smallest class, and its text is compared with that one
alone. Steps 3 and 4 then test the pairs that are still in different groups, so the groups are
the same and a family of near copies costs a text per class and level, not per pair of blocks.

Null or empty texts have no shingles and no links. Rows without an id take no part
(group null, no links). Repeated rows count as copies. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .groups import components, whole_groups
from .runtime import Shield, likely_members, prepare, written
from .words import U, mix, slices, windows

SHINGLE, TREES, DEPTH = 5, 18, 6
TARGET = 0.99999
#: Similarity threshold as a fraction: intersection x 5 >= union x 4.
NUM, DEN = 4, 5
#: Classes per block, and shingles per block of texts.
BLOCK, TEXT_SHINGLES = 1024, 1 << 20


def depths(trees: int = TREES, depth: int = DEPTH, similarity: float = NUM / DEN, target: float = TARGET) -> np.ndarray:
    """Values that a pair must share in each tree: prefixes are shortened from the whole
    ones, a level and a tree at a time, until a pair of the similarity is found with
    probability ``target``."""
    at = np.full(trees, depth)
    for level in range(depth - 1, -1, -1):
        for t in range(trees):
            if 1 - np.prod(1 - similarity ** at) >= target:
                return at
            if level:
                at[t] = level
    raise ValueError(f"{trees} trees of {depth} values do not find pairs of {similarity} with probability {target}")


AT = depths()

_rng = np.random.default_rng(5_2024)
_XOR = _rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(s) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a slice (repeats included) and their borders per text."""
    h = s.hashes()
    w, ptr = windows(h, s.ptr, SHINGLE)
    few = np.flatnonzero((s.n_words > 0) & (s.n_words < SHINGLE))
    if not len(few):
        return w, ptr
    count = np.diff(ptr)
    count[few] = 1
    out_ptr = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(out_ptr[-1], U)
    alone = np.zeros(len(out), bool)
    alone[out_ptr[few]] = True
    out[~alone] = w
    with np.errstate(over="ignore"):
        for k in few:  # at most four words each
            v = U(s.n_words[k])
            for x in h[s.ptr[k]:s.ptr[k + 1]]:
                v = v * U(0x9E3779B97F4A7C15) + x
            out[out_ptr[k]] = mix(np.array([v]))[0]
    return out, out_ptr


def signatures(col: pa.Array) -> tuple[list[bytes | None], np.ndarray, list[bytes | None]]:
    """Of each text: fingerprint (null without shingles), number of shingles, MinHash values."""
    marks, sizes, sigs = [], [], []
    for s in slices(col):
        h, ptr = shingles(s)
        n = np.diff(ptr)
        full = np.flatnonzero(n)
        starts = ptr[:-1][full]
        got = np.zeros((len(full), 2), U)
        sig = np.empty((len(full), TREES * DEPTH), np.uint32)
        if len(full):
            with np.errstate(over="ignore"):
                got[:, 0] = np.add.reduceat(mix(h), starts)
                got[:, 1] = np.add.reduceat(mix(h ^ U(0x5851F42D4C957F2D)), starts)
            sig[:] = np.uint32(0xFFFFFFFF)
            high = (h >> U(32)).astype(np.uint32)
            step = 1 << 16  # shingles at a time: they stay in the cache
            for lo in range(0, len(high), step):
                part = high[lo:lo + step]
                a = int(np.searchsorted(starts, lo, side="right")) - 1
                z = int(np.searchsorted(starts, lo + len(part)))
                at = np.maximum(starts[a:z] - lo, 0)
                for j in range(TREES * DEPTH):
                    v = (part ^ _XOR[j]) * _MUL[j]
                    np.minimum(sig[a:z, j], np.minimum.reduceat(v, at), out=sig[a:z, j])
        low = mix(sig.astype(U)).astype(np.uint16)
        mark, val = [None] * len(s), [None] * len(s)
        for k, i in enumerate(full):
            mark[i], val[i] = got[k].tobytes(), low[k].tobytes()
        marks += mark
        sigs += val
        sizes.append(n)
    return marks, np.concatenate(sizes) if sizes else np.zeros(0, np.int64), sigs


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, node, size, sig) of every document row, written."""
    def run(batches):
        for b in batches:
            marks, sizes, sigs = signatures(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(marks, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(sigs, pa.binary())], names=["doc_id", "node", "size", "sig"])
    return written(docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, node binary, size long, sig binary"), "signed")


# --- forest -----------------------------------------------------------------------

def _depth() -> Column:
    """The depth at which the search of a row's tree ends."""
    return F.element_at(F.array(*[F.lit(int(d)) for d in AT]), F.col("tree") + 1)


def forest(classes: DataFrame) -> DataFrame:
    """(tree, prefix, node): classes that share ``AT`` values of a tree; prefix has all values."""
    def rows(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(-1, TREES, DEPTH)
            for t in range(TREES):
                values = sig[:, t].astype(">u2").tobytes()
                n = 2 * DEPTH
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, t, np.int32)),
                     pa.array([values[k:k + n] for k in range(0, len(values), n)], pa.binary()),
                     b.column("node")], names=["tree", "prefix", "node"])

    def shared(batches):
        last = None  # (key, row) of a run with one row so far
        for b in batches:
            tree = b.column("tree").to_numpy()
            prefix = b.column("prefix").to_pylist()
            keep = np.zeros(b.num_rows, bool)
            before = None
            keys = [(t, p[:2 * AT[t]]) for t, p in zip(tree.tolist(), prefix)]
            for k, key in enumerate(keys):
                if k and key == keys[k - 1]:
                    keep[k - 1] = keep[k] = True
                elif not k and last is not None and key == last[0]:
                    keep[0] = True
                    before = last[1]
            if before is not None:
                yield before
            if b.num_rows:
                yield b.filter(pa.array(keep))
                # the last row waits, unless it is known to be shared
                last = (keys[-1], None if keep[-1] else b.slice(b.num_rows - 1))
    dealt = (classes.select("node", "sig").mapInArrow(rows, "tree int, prefix binary, node binary")
             .repartition("tree", F.substring("prefix", F.lit(1), 2 * _depth()))
             .sortWithinPartitions("tree", "prefix"))
    return written(dealt.mapInArrow(shared, "tree int, prefix binary, node binary"), "forest")


def _codes(x: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """One number per tree: its first values, ``depth`` of each tree."""
    out = np.zeros((len(x), TREES), U)
    with np.errstate(over="ignore"):
        for k in range(DEPTH):
            on = np.flatnonzero(depth > k)
            out[:, on] = mix(out[:, on] * U(0x9E3779B97F4A7C15) + x[:, on, k].astype(U) + U(1))
    return out


def _likely(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (row i of a, row j of b) those that the signatures do not rule out."""
    least = (NUM / DEN - 5 * np.sqrt(NUM * (DEN - NUM)) / DEN / np.sqrt(TREES * DEPTH)) * TREES * DEPTH
    same = np.zeros(len(i), np.int64)
    for k in range(0, len(i), 1 << 16):
        x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
        same[k:k + (1 << 16)] = (a[x] == b[y]).sum(axis=(1, 2))
    keep = same >= least
    return i[keep], j[keep]


def _due(a: np.ndarray, b: np.ndarray, apart: np.ndarray, tree: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b of the pairs to test at a node: of those ``apart`` the ones that match
    nowhere at a longer prefix, nor at one of this length in an earlier tree."""
    if level < DEPTH:
        apart = apart & (a[:, None, tree, level] != b[None, :, tree, level])
    i, j = np.nonzero(apart)
    depth = np.maximum(AT, level + (np.arange(TREES) >= tree))
    ca, cb = _codes(a, depth), _codes(b, depth)
    for t in np.flatnonzero(depth <= DEPTH):
        new = ca[i, t] != cb[j, t]
        i, j = i[new], j[new]
    return i, j


def _sigs(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, TREES, DEPTH)


_UNIT = ["tree", "level", "prefix", "bi", "bj"]


def _local(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each vertex's component among n vertices with edges i - j."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _candidates(batches):
    """Units of signatures -> (a, b, level) edges of local components."""
    for b, at in whole_groups(batches, _UNIT):
        tree, level, bi, bj, side, known = (b.column(c).to_numpy() for c in ("tree", "level", "bi", "bj", "side", "known"))
        sig = _sigs(b.column("sig"))
        left, right = [], []
        for lo, hi in zip(at, at[1:]):
            one = bi[lo] == bj[lo]
            x = np.arange(lo, hi) if one else lo + np.flatnonzero(side[lo:hi] == 0)
            y = x if one else lo + np.flatnonzero(side[lo:hi] == 1)
            apart = known[x][:, None] != known[y][None, :]
            i, j = _due(sig[x], sig[y], np.triu(apart, 1) if one else apart, int(tree[lo]), int(level[lo]))
            i, j = _likely(sig[x], sig[y], i, j)
            if not len(i):
                continue
            label = lo + _local(hi - lo, x[i] - lo, y[j] - lo)
            far = np.flatnonzero(label != np.arange(lo, hi))
            left += (lo + far).tolist()
            right += label[far].tolist()
        if left:
            node = b.column("node").cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(left)), node.take(pa.array(right)), pa.array(level[left], pa.int32())],
                names=["a", "b", "level"])


def _sets(col: pa.Array) -> tuple[list[bytes | None], list[np.ndarray]]:
    """Fingerprint and distinct shingles of each text."""
    marks, sets = [], []
    for s in slices(col):
        h, ptr = shingles(s)
        for a, z in zip(ptr, ptr[1:]):
            x = h[a:z]
            with np.errstate(over="ignore"):
                marks.append(np.array([mix(x).sum(dtype=U), mix(x ^ U(0x5851F42D4C957F2D)).sum(dtype=U)]).tobytes())
            sets.append(np.unique(x))
    return marks, sets


def intersections(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted distinct sets (of one with itself)."""
    n = len(a)
    if n * len(b or a) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in b or a] for x in a])
    sets = a + (b or [])
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[col] > 1
    number = np.cumsum(count > 1) - 1
    row, col = row[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((n, len(b or a)), np.int64)
    width = 2048
    for lo in range(0, int((count > 1).sum()), width):
        s, e = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((len(sets), width), np.float32)
        m[row[s:e], col[s:e] - lo] = 1
        out += (m[:n] @ (m[n:] if b else m).T).astype(np.int64)
    if not b:
        out[np.arange(n), np.arange(n)] = [len(x) for x in a]
    return out


_PART = ["cluster", "bi", "bj"]


def _verified(batches):
    """Blocks of a component with texts -> (node, links, first class of the links' component)."""
    for b, at in whole_groups(batches, _PART):
        marks, sets = _sets(b.column("text"))
        node = b.column("node").to_pylist()
        sig, weight = _sigs(b.column("sig")), b.column("weight").to_numpy()
        side, bi, bj, known = (b.column(c).to_numpy() for c in ("side", "bi", "bj", "known"))
        out = []
        for lo, hi in zip(at, at[1:]):
            # an id may have had other texts too: take the one of this class, once
            own, seen = [], set()
            for k in range(lo, hi):
                if marks[k] == node[k] and node[k] not in seen:
                    seen.add(node[k])
                    own.append(k)
            own = np.array(own, np.int64)
            one = bi[lo] == bj[lo]
            x, y = (own, own) if one else (own[side[own] == 0], own[side[own] == 1])
            if not len(x) or not len(y):
                continue
            ca, cb = _codes(sig[x], AT), _codes(sig[y], AT)
            match = np.zeros((len(x), len(y)), bool)
            for t in range(TREES):
                match |= ca[:, None, t] == cb[None, :, t]
            match &= known[x][:, None] != known[y][None, :]
            i, j = _likely(sig[x], sig[y], *np.nonzero(np.triu(match, 1) if one else match))
            if not len(i):
                continue
            inter = intersections([sets[k] for k in x], None if one else [sets[k] for k in y])[i, j]
            size = np.array([len(sets[k]) for k in range(lo, hi)])
            union = size[x[i] - lo] + size[y[j] - lo] - inter
            link = inter * DEN >= union * NUM
            # the smallest neighbours alone would not hold a chain of links together
            first_of = lo + _local(hi - lo, x[i[link]] - lo, y[j[link]] - lo)
            ends = np.concatenate([x[i[link]], y[j[link]]])
            other = np.concatenate([y[j[link]], x[i[link]]])
            order = np.argsort(ends, kind="stable")
            ends, other = ends[order], other[order]
            first = np.flatnonzero(np.diff(ends, prepend=-1))
            for s, e in zip(first, [*first[1:], len(ends)]):
                far = other[s:e]
                out.append((node[ends[s]], int(weight[far].sum()), node[first_of[ends[s] - lo]]))
        if out:
            c = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.binary()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.binary())],
                names=["node", "links", "label"])


def _block_pairs(rows: DataFrame) -> DataFrame:
    """A row per pair of blocks that a row (with ``node`` and ``blocks``) takes part in."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (rows.withColumn("own", own)
            .withColumn("far", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("bi", F.least("own", "far")).withColumn("bj", F.greatest("own", "far"))
            .withColumn("side", F.when(F.col("own") <= F.col("far"), 0).otherwise(1))
            .drop("own", "far", "blocks"))


def _known(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with ``known``, a number of the group that their class is in so far."""
    if labels is None:
        return rows.withColumn("known", F.xxhash64("node"))
    return rows.join(labels, "node", "left").withColumn("known", F.xxhash64(F.coalesce("label", "node"))).drop("label")


def _nodes(trees: DataFrame) -> DataFrame:
    """(tree, level, prefix, child, node): the nodes above each row, longest prefix first."""
    return (trees.withColumn("level", F.explode(F.sequence(F.lit(DEPTH), _depth(), F.lit(-1))))
            .select("tree", "level", F.substring("prefix", F.lit(1), 2 * F.col("level")).alias("prefix"),
                    F.substring("prefix", 2 * F.col("level") + 1, F.lit(2)).alias("child"), "node"))


def _edges(trees: DataFrame, shared: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(a, b, level) candidate edges of the pairs that share a node, written; with ``labels``
    (node, label) of the pairs in different groups."""
    key = ["tree", "level", "prefix"]
    rows = _known(_nodes(trees), labels)
    groups = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"),
                                     ((F.col("level") == DEPTH) | (F.min("child") < F.max("child"))).alias("forked"),
                                     (F.min("known") < F.max("known")).alias("apart"))
              .filter("forked and apart").select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    units = (_block_pairs(rows.drop("child").join(groups, key)).join(shared, "node")
             .select(*_UNIT, "side", "node", "known", "sig").repartition(*_UNIT).sortWithinPartitions(*_UNIT, "node"))
    return written(units.mapInArrow(_candidates, "a binary, b binary, level int"), "edges")


def _texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` (with ``rep``) and the texts of those ids: every one, if an id has several."""
    need = rows.select(F.col("rep").alias("doc_id")).distinct()
    # only candidates' texts are shuffled (an inner join: the optimizer would move a
    # semi-join below the bitmap)
    texts = (likely_members(docs.select("doc_id", "text"), need, "doc_id").join(need, "doc_id")
             .withColumn("t", F.xxhash64("text")).dropDuplicates(["doc_id", "t"])
             .select(F.col("doc_id").alias("rep"), "text"))
    return rows.join(texts, "rep")


def _linked(units: DataFrame) -> DataFrame:
    """(node, links, label) of the verified links of units with texts, written."""
    dealt = (units.select(*_PART, "side", "node", "weight", "known", "sig", "text")
             .repartition(*_PART).sortWithinPartitions(*_PART, "node"))
    return written(dealt.mapInArrow(_verified, "node binary, links long, label binary"), "links")


def _blocks() -> Column:
    """Blocks of a cluster of classes, by number and by shingles."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / TEXT_SHINGLES)).cast("int").alias("blocks")


def _verify(edges: DataFrame, classes: DataFrame, docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Links among the candidates."""
    clusters = written(_known(components(edges).withColumnRenamed("label", "cluster"), labels).join(classes, "node")
                       .select("cluster", "node", "known", "rep", "weight", "size", "sig"), "clusters")
    blocks = clusters.groupBy("cluster").agg(_blocks())
    return _linked(_block_pairs(_texts(clusters.drop("size").join(blocks, "cluster"), docs)))


def _descent(trees: DataFrame, full: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """(links, labels) found from the longest prefixes down, a text per class and level.

    ``full``: node, weight, size, sig, text of the classes in ``trees``. At each level a node
    whose classes have one label is done; else one class of each label meets the node's
    smallest class. A pair is tested once.
    """
    links = labels = tested = None
    for level in range(DEPTH, int(AT.min()) - 1, -1):
        rows = _known(_nodes(trees).filter(F.col("level") == level), labels)
        heads = rows.groupBy("tree", "prefix", "known").agg(F.min("node").alias("a"))
        hubs = heads.groupBy("tree", "prefix").agg(F.min("a").alias("b"), F.max("a").alias("z")).filter("b < z").drop("z")
        pairs = heads.join(hubs, ["tree", "prefix"]).filter("a != b").select("a", "b")
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs.groupBy("a").agg(F.min("b").alias("b")), "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        sizes = pairs.join(full.select(F.col("node").alias("a"), "size"), "a").groupBy("b").agg(_blocks())
        ends = (pairs.join(sizes, "b").select(F.col("b").alias("cluster"), F.col("a").alias("node"), F.lit(0).alias("side"),
                                              F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("bi"))
                .unionByName(sizes.select(F.col("b").alias("cluster"), F.col("b").alias("node"), F.lit(1).alias("side"),
                                          F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("bi"))))
        found = _linked(_known(ends.withColumn("bj", F.lit(-1)), None).join(full, "node"))
        links = found if links is None else links.unionByName(found)
        labels = components(links.select(F.col("node").alias("a"), F.col("label").alias("b")))
    return links, labels


def join(docs: DataFrame) -> DataFrame:
    """doc_id, group_id, n_links, n_copies of every document row.

    ``group_id``: smallest id of the documents connected by links (copies included);
    ``n_links``: other documents of similarity >= 0.8, copies included; ``n_copies``:
    other documents with the same shingles.
    """
    return _placed(docs)


def _placed(docs: DataFrame, clusters: bool = False) -> DataFrame:
    """:func:`join`; with ``clusters`` also node and cluster, one value per group, and n_links
    counts only the links that were needed to find the groups."""
    prepare(docs.sparkSession)
    sign = signed(docs)
    some = sign.filter(F.col("doc_id").isNotNull() & F.col("node").isNotNull())
    classes = written(some.groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.min("size").alias("size"),
        F.min("sig").alias("sig")), "classes")
    trees = forest(classes)
    # the signatures of those classes only that share a prefix with another one
    shared = written(classes.join(trees.select("node").distinct(), "node", "left_semi").select("node", "sig"), "shared")
    early = labels = None
    if clusters:
        own = classes.join(shared.select("node"), "node").select("node", "rep", "weight", "size", "sig")
        early, labels = _descent(trees, written(_texts(own, docs).drop("rep"), "texts"))
    found = _verify(_edges(trees, shared, labels), classes, docs, labels)
    if clusters:
        found = early.unionByName(found)
    links = written(found.groupBy("node").agg(F.sum("links").alias("links"),
                                              F.collect_set("label").alias("near")), "links")
    label = components(links.select(F.col("node").alias("a"), F.explode("near").alias("b")))
    found = (links.select("node", "links").join(label, "node").join(classes.select("node", "rep"), "node"))
    least = found.groupBy("label").agg(F.min("rep").alias("group"))
    grouped = found.join(least, "label").select("node", "links", "group", *["label"] * clusters)
    cluster = [F.coalesce("label", "node").alias("cluster")] * clusters
    info = written(classes.select("node", "rep", "weight").join(grouped, "node", "left")
                   .filter((F.col("weight") > 1) | F.col("group").isNotNull())
                   .select("node", (F.col("weight") - 1).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"),
                           F.coalesce("group", "rep").alias("group"), *cluster), "groups")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise
    return (sign.select("doc_id", "node").join(info, "node", "left")
            .select("doc_id", own(F.coalesce("group", "doc_id")).cast("long").alias("group_id"),
                    F.coalesce(own(F.col("copies") + F.col("links")), F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce(own(F.col("copies")), F.lit(0)).cast("long").alias("n_copies"),
                    *["node", F.coalesce("cluster", "node").alias("cluster")] * clusters))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: one of the smallest id.

    Rows are judged by their own group: an id's further rows with other texts stay unless
    their own groups have an earlier id. Rows without an id or without shingles stay.
    """
    rows = written(_placed(docs, True), "joined")
    drop = written(rows.filter(F.col("group_id") != F.col("doc_id")).select("doc_id").distinct(), "dropped")
    twice = written(rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1")
                    .select("doc_id"), "repeated")
    kept = docs.join(drop, "doc_id", "left_anti").select(*docs.columns)
    if twice.isEmpty():
        return kept
    first = (rows.filter(F.col("node").isNotNull() & (F.col("group_id") == F.col("doc_id")))
             .join(twice, "doc_id", "left_semi").select("doc_id", "node", "cluster").distinct())
    shield = Shield(docs, "doc_id")
    again = shield.inner.join(twice, "doc_id").select("row", "text", "doc_id")

    def marked(batches):
        for b in batches:
            marks = pa.array(signatures(b.column("text"))[0], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, marks], names=[*b.schema.names, "node"])
    again = (again.mapInArrow(marked, StructType([*again.schema.fields, StructField("node", BinaryType())]))
             # rows without shingles are in no group: each has a number of its own
             .withColumn("alone", F.when(F.col("node").isNull(), F.monotonically_increasing_id()))
             .join(first, ["doc_id", "node"], "left")
             .filter(F.col("alone").isNotNull() | F.col("cluster").isNotNull())
             .dropDuplicates(["doc_id", "cluster", "alone"]))
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(shield.restore(again))
