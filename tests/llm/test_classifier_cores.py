"""Features, fitting and scoring of the two classifiers against loops over plain Python values."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logwright.llm import labels as L
from logwright.llm import quality_model as Q
from logwright.llm import toxicity as T
from logwright.llm.words import mix, slices

WORD = re.compile("[^\x20\x09-\x0d]+")
M64 = (1 << 64) - 1
PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FOLDED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PUNCT, "abcdefghijklmnopqrstuvwxyz" + " " * len(PUNCT))


def texts(n=60, seed=8):
    rng = random.Random(seed)
    vocab = ["red", "Green", "blueish", "über", "longerword", "x", "#tag", "a|b", "1234", "end.", "so!", "Q" * 20]
    out = ["", None, "   ", "one", "two words", "same\nsame\n\nsame\n", "日本語 テキスト"]
    for _ in range(n):
        out.append("".join(rng.choice(vocab) + rng.choice([" ", " ", "\n", "\t"]) for _ in range(rng.choice([1, 5, 40, 300]))))
    return out


def word_hash(word: bytes) -> int:
    s = next(slices(pa.array([word.decode("latin-1")]))) if word.isascii() else None
    if s is not None:
        return int(s.hashes()[0])
    raw = np.frombuffer(word, np.uint8)  # a stem may cut a character
    from logwright.llm.words import Slice
    return int(Slice(0, raw, np.array([0, len(raw)]), None).hashes()[0])


def mixed(x: int) -> int:
    return int(mix(np.array([x & M64], np.uint64))[0])


def plain_features(text) -> set:
    words = [w.encode() for w in WORD.findall((text or "").translate(FOLDED))]
    h = [word_hash(w) for w in words]
    out = {mixed(x ^ 1) for x in h}
    out |= {mixed(word_hash(w[:k]) ^ k) for w in words for k in (4, 5, 6) if len(w) > k}
    for gap, step in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        out |= {mixed(h[i] * step + h[i + gap]) for i in range(len(h) - gap)}
    return {x >> 44 for x in out}


def batch_features(rows) -> list:
    out = []
    for s in slices(pa.array(rows), T._FOLD):
        of, at = T.features(s)
        out += [set(at[of == k].tolist()) for k in range(len(s))]
    return out


def test_toxicity_features():
    rows = texts()
    assert batch_features(rows) == [plain_features(t) for t in rows]


def plain_ftrl(features, y):
    """FTRL-proximal with dictionaries, a coordinate at a time."""
    z, n = defaultdict(float), defaultdict(float)
    bias = 1 << T.BITS

    def weight(i):
        l1 = 0.0 if i == bias else T.L1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((T.BETA + math.sqrt(n[i])) / T.ALPHA + T.L2)
    order = np.random.default_rng(7)
    for _ in range(T.EPOCHS):
        for k in order.permutation(len(features)):
            at = [*features[k], bias]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y[k]
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / T.ALPHA * w[i]
                n[i] += g * g
    return {i: weight(i) for i in [*z] if weight(i)}


def marked(n=240, seed=4):
    rng = random.Random(seed)
    good, bad = [f"plain{k}" for k in range(60)], [f"nasty{k}" for k in range(8)]
    rows = []
    for k in range(n):
        y = k % 3 == 0
        w = [rng.choice(good) for _ in range(rng.choice([5, 30]))] + ([rng.choice(bad) for _ in range(3)] if y else [])
        rng.shuffle(w)
        rows.append((k, " ".join(w), int(y)))
    return rows


def test_ftrl_and_scores():
    rows = marked()
    features = [sorted(plain_features(t)) for _, t, _ in rows]
    y = [v for _, _, v in rows]
    want = plain_ftrl(features, y)
    at, w = T.ftrl([np.array(f, np.int32) for f in features], np.array(y, float))
    assert len(want) > 5 and set(at.tolist()) == set(want)
    assert np.allclose(w, [want[i] for i in at.tolist()], atol=1e-9)
    score = T.score_batch(pa.array([t for _, t, _ in rows]), at, w)
    raw = [sum(want.get(i, 0.0) for i in [*f, 1 << T.BITS]) for f in features]
    assert np.allclose(score, [1 / (1 + math.exp(-r)) for r in raw], atol=1e-5)


def frames(spark, rows, extra_labels=()):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(i, y) for i, _, y in rows] + list(extra_labels), "doc_id long, toxic int")
    return docs, marks


def test_toxicity_training_uses_whole_texts_and_found_documents(spark, monkeypatch):
    rows = marked()
    fitted = [r for r in rows if not L_held(r[0])]
    docs, marks = frames(spark, rows)
    at, w = T.train(docs, marks)
    want = plain_ftrl([sorted(plain_features(t)) for _, t, _ in fitted], [y for *_, y in fitted])
    assert set(at.tolist()) == set(want) and np.allclose(w, [want[i] for i in at.tolist()], atol=1e-9)
    # labels of ids without a document change nothing
    _, more = frames(spark, rows, [(k, k % 2) for k in range(100_000, 118_000)])
    at2, w2 = T.train(docs, more, bound=len(rows))
    assert np.array_equal(at, at2) and np.array_equal(w, w2)
    # documents that are all very long are learned from whole
    pad = "filler " * 40_000
    long = [(i, pad + t, y) for i, t, y in rows]
    at, w = T.train(*frames(spark, long))
    assert len(at) > 5
    score = T.score_batch(pa.array([t for _, t, _ in long]), at, w)
    assert min(s for s, r in zip(score, long) if r[2]) > max(s for s, r in zip(score, long) if not r[2])


def L_held(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_toxicity_groups_are_bounded_in_bytes(spark, monkeypatch):
    rows = marked(400)
    docs, marks = frames(spark, rows)
    monkeypatch.setattr(T, "SHARD_BYTES", 16_000)
    fitted = [(i, sorted(plain_features(t)), y) for i, t, y in rows if not L_held(i)]
    size = {i: 4 * len(f) + T.ROW_BYTES for i, f, _ in fitted}
    order = [r[0] for r in spark.createDataFrame([(i,) for i in size], "doc_id long")
             .orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    total = sum(size.values())
    shards = -(-total // 16_000)
    groups, before = defaultdict(list), 0
    for i in order:
        groups[before * shards // total].append(i)
        before += size[i]
    assert shards > 3 and max(sum(size[i] for i in g) for g in groups.values()) < 16_000 + max(size.values())
    mean = Counter()
    for g in groups.values():
        part = [r for r in fitted if r[0] in set(g)]
        for k, v in plain_ftrl([f for _, f, _ in part], [y for *_, y in part]).items():
            mean[k] += v / shards
    at, w = T.train(docs, marks)
    assert set(at.tolist()) == set(mean) and np.allclose(w, [mean[i] for i in at.tolist()], atol=1e-9)


# --- quality classifier -------------------------------------------------------------

def plain_statistics(text) -> list:
    t = text or ""
    words, c = WORD.findall(t), max(len(t), 1)
    w, lines = max(len(words), 1), [x for x in t.split("\n") if x]
    ln = max(len(lines), 1)
    count = lambda chars: sum(x in chars for x in t)
    blank = " \t\n\v\f\r"
    size = [len(x.encode()) for x in words]
    pairs = list(zip(words, words[1:]))
    return [len(t), len(words), sum(x not in blank for x in t) / w, sum(s > 15 for s in size) / w,
            sum(s == 1 for s in size) / w, count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / c, count("0123456789") / c,
            count("#*$%&|<>") / c, count("|") / w, count(".") / w, count(",") / w, count("!") / w,
            sum(ord(x) > 127 for x in t) / c, len(lines), len(words) / ln, 1 - len(set(lines)) / ln,
            len(set(words)) / w, max(Counter(words).values(), default=0) / w,
            1 - len(set(pairs)) / max(len(words) - 1, 1), sum(x[-1] in "#*$%&|<>" for x in words) / w,
            count(blank) / c]


def test_quality_statistics():
    rows = texts()
    got = Q.statistics(pa.array(rows))
    for t, x in zip(rows, got):
        assert np.allclose(x, np.array(plain_statistics(t), np.float32), atol=1e-5), t


def test_tree_walk_and_first_split():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, len(Q.NAMES))).astype(np.float32)
    y = (x[:, 3] + 0.1 * x[:, 7] > 0.2).astype(float)
    m = Q.fit(x, y)
    raw = []
    for row in x[:60]:
        total = m.prior
        for node in m.roots.tolist():
            while m.left[node] != node:
                node = int(m.left[node] if row[m.feature[node]] <= m.threshold[node] else m.right[node])
            total += m.value[node]
        raw.append(1 / (1 + math.exp(-total)))
    assert np.allclose(m.score(x[:60]), raw, atol=1e-12)
    # the first tree's root: the best gain over all features and cuts
    p = (y.sum() + 0.5) / (len(y) + 1)
    grad, hess = p - y, np.full(len(y), p * (1 - p))
    best = (-1.0, None, None)
    for j in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, j], np.linspace(0, 1, Q.BINS + 1)[1:-1], method="lower")):
            low = x[:, j] <= cut
            if min(hess[low].sum(), hess[~low].sum()) < Q.LEAF / 4:
                continue
            part = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + Q.L2)
            best = max(best, (part(low) + part(~low), j, float(cut)))
    root = m.roots[0]
    assert (m.feature[root], float(m.threshold[root])) == best[1:]
