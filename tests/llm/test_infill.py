"""Fill-in-middle against a plain Python version, and the exact round trip."""

import hashlib
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from logwright.llm import infill

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text, seed=1):
    """The transformation written down without chunks."""
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:z]), "".join(tokens[z:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(5)
    words = ["foo", "Bar", "bäz", "1", "?", "日本", "<", "<P", "S>", "<M"]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = make(4000)  # chunks that texts share
    out = ["", None, "a", "é", "<", "ab<P>cd", "x<S>", "<M>", "日本 語x", "\n\n", " ", "x" * 30_000, "é" * 30_000,
           "日" * 9_000 + "a", shared, shared, "q" + shared, "Q" + shared + "Q"]
    return out + [make(rng.choice([1, 2, 30, 600])) + shared[:k * 97] + "tail" * (k % 2) for k in range(120)]


def test_batches_against_plain_python():
    rows = texts()
    ids = [None if k == 3 else k - 5 for k in range(len(rows))]
    want = [plain(i, t) for i, t in zip(ids, rows)]
    for _ in range(2):  # the second time from the cache
        got = zip(*infill.transform_batch(ids, pa.array(rows), 1))
        assert [(*g[:4], g[4].decode()) for g in got] == want
    assert {w[1] for w in want} == {"plain", "psm", "spm"}


def test_chunks_follow_content():
    shared = texts()[14].encode()
    import numpy as np
    at = lambda head: {c - len(head) for c in infill.cuts(
        np.frombuffer(head + shared, np.uint8), np.array([0, len(head) + len(shared)])).tolist()}
    one, two = at(b"short"), at(b"another beginning " * 50)
    assert len(one) > 20 and len({c for c in one if c > 0} - two) <= 1


def test_cache_is_bounded_and_compares_content():
    memo = infill.Memo(limit=1000)
    chunks = [bytes([97 + k % 26]) * 100 + str(k).encode() for k in range(200)]
    first = infill.summaries(chunks, memo)
    assert sum(map(len, memo.new)) <= 1000 and sum(map(len, memo.old)) <= 1000
    assert (infill.summaries(chunks[::-1], memo)[::-1] == first).all()
    a, b = infill.summaries([b"ab", b"1b"], memo)
    assert a.tolist() == [1, 2, 1, 1] and b.tolist() == [2, 2, 0, 1]


def test_round_trip_with_extra_columns(spark):
    rows = texts()
    docs = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in enumerate(rows)] + [(0, "twice", "x", 1, "y")],
                                 "doc_id long, text string, output string, n long, form string").repartition(3)
    out = infill.fill_in_middle(docs)
    got = out.withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        text = rows[r["doc_id"]] if (r["doc_id"], r["n"]) != (0, 1) else "twice"
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], text)
        assert r["back"] == (text or "")
    assert infill.digests(infill.fill_in_middle(docs.limit(0))).count() == 0
    other = {r["doc_id"]: r["output"] for r in infill.fill_in_middle(docs, seed=2).collect()}
    assert other[14] == plain(14, rows[14], seed=2)[4]
