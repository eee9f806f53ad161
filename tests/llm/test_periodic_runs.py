"""Run enumeration and LCE against brute force, and the registered query on a fixture."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa

from logwright.llm import periodic_runs as R
from logwright.llm.queries import QUERIES


def brute(w):
    """All runs by comparing every word with the one p places on, for every p."""
    found = {}
    for p in range(1, len(w) // 3 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(24, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1 if j == i else j
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    return " ".join(x for i, x in enumerate(w) if not any(s + p <= i < s + length for s, length, p in runs))


def texts(seed=2, n=250):
    rng = random.Random(seed)
    out = ["", None, "  \n", "x " * 24, "x " * 23, "a b " * 12, "a b " * 11 + "a", "x\n" * 3000,
           "é ü " * 40, ("a " * 30 + "b ") * 4]
    for _ in range(n):
        letters = rng.choice([["a"], ["a", "b"], ["a", "b", "c"], [f"w{i}" for i in range(50)]])
        w, size = [], rng.choice([5, 30, 100, 400])
        while len(w) < size:
            w += [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 9, 20, 40]))] * rng.choice([1, 1, 2, 3, 5, 20])
        out.append(" ".join(w))
    return out


def test_batches_against_brute_force():
    rows = texts()
    got = list(R.runs_batch(list(range(len(rows))), pa.array(rows)))
    total = 0
    for t, (runs, kept) in zip(rows, got):
        w = (t or "").split()
        want = brute(w)
        total += len(want)
        assert [tuple(r) for r in runs.tolist()] == want
        assert kept.decode() == collapse(w, want)
    assert total > 100


def test_hits_in_many_blocks(monkeypatch):
    monkeypatch.setattr(R, "HITS", 7)
    rows = texts(9, 40)
    for t, (runs, _) in zip(rows, R.runs_batch(list(range(len(rows))), pa.array(rows))):
        assert [tuple(r) for r in runs.tolist()] == brute((t or "").split())


def test_extensions_of_any_two_positions():
    rng = np.random.default_rng(4)
    for n in (1, 2, 30, 31, 32, 62, 400):
        for letters in (1, 2, 3):
            w = rng.integers(1, letters + 1, n).astype(np.uint64)
            i, j = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n + 1)))
            i, j = i[i < j], j[i < j]
            want = []
            for a, b in zip(i.tolist(), j.tolist()):
                k = 0
                while b + k < n and w[a + k] == w[b + k]:
                    k += 1
                want.append(k)
            assert R.Extensions(w).common(i, j).tolist() == want


def test_every_residue_is_a_difference_of_the_cover():
    assert {(a - b) % R.PERIOD for a in R.COVER for b in R.COVER} == set(range(R.PERIOD))


def test_best_run_ties():
    assert R.best_run(np.zeros((0, 3), np.int64)) is None
    assert R.best_run(np.array([[9, 30, 10], [3, 30, 10], [3, 33, 11], [0, 29, 10]])) == [3, 30, 10]
    big = 10 ** 9 + 7  # exact where doubles tie
    assert R.best_run(np.array([[0, 3 * big + 1, big], [5, 3 * big + 4, big + 1]])) == [0, 3 * big + 1, big]


def test_registered_query_on_a_fixture(spark, tmp_path):
    rows = texts(7, 80)
    ids = [None if k == 5 else 17 if k in (20, 21) else k - 3 for k in range(len(rows))]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in zip(ids, rows)],
                                 "doc_id long, text string, runs string, start int").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want, planted = [], 0
    for i, t in zip(ids, rows):
        w = (t or "").split()
        n, h = len(w), None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            planted += 1
        runs = brute(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
                     sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(collapse(w, runs))))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=key) == sorted(want, key=key)
    assert planted > 3 and sum(w[1] > 0 for w in want) > 10
    assert R.find_runs(docs.limit(0)).count() == 0
