"""Language identification: features and cosines by hand, held-out accuracy, odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logwright.llm import language as G
from logwright.llm.labels import held_out
from logwright.llm.queries import QUERIES

M32 = (1 << 32) - 1


def plain_counts(text):
    """Hashed byte n-grams of a text, one at a time."""
    data, out = bytearray(), Counter()
    for c in (text or "").encode():
        c = c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32
        if not (c == 32 and data and data[-1] == 32):
            data.append(c)
    for size in (1, 2, 3, 4):
        for i in range(len(data) - size + 1):
            gram = int.from_bytes(data[i:i + size], "little")
            place = ((gram + size) * 2654435761 & M32) ^ (size * 0x27D4EB2F & M32)
            out[(place * 2246822519 & M32) >> 19] += 1
    return out


def plain_judge(text, model):
    """Language and cosine from dictionaries."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    v = {p: (1 + math.log(c)) * float(model.idf[p]) for p, c in plain_counts(text).items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    sims = [sum(x * float(c[p]) for p, x in v.items()) / size if size else 0.0 for c in model.centroids]
    return sims


SYLLABLES = {"aa": "ka lo mi tu ren sa".split(), "bb": "sch ung ver heit ßen ör".split(),
             "cc": "ción que ñar los ido ía".split()}


def corpus(n=160, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))
                 for _ in range(rng.choice([3, 20, 200]))]
        rows.append((k, " ".join(words).capitalize() + ".", lang))
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !! 34", "cc"), (1003, "日本語", None), (1004, "é", None),
             (None, "ka lo mi", "aa"), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]),
             (1005, "ka lo " * 300_000, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.0, True) for r in rows],
                                 "doc_id long, text string, lang string, k string, score double, rejected boolean").repartition(3)


@pytest.fixture(scope="module")
def fitted(spark):
    docs = frame(spark, corpus())
    return docs, G.train(docs)


def test_counts_against_plain_python(monkeypatch):
    rows = [r[1] for r in corpus(30)][:-1]
    for piece in (G.PIECE, 64):  # the second: texts over many pieces
        monkeypatch.setattr(G, "PIECE", piece)
        got = np.concatenate(list(G.frequencies(pa.array(rows))))
        for t, x in zip(rows, got):
            want = np.zeros(G.PLACES)
            if any(c.isalpha() for c in t or ""):
                for p, c in plain_counts(t).items():
                    want[p] = 1 + math.log(c)
            assert np.allclose(x, want, atol=1e-5)


def test_judgement_against_plain_python(fitted):
    docs, model = fitted
    assert set(model.langs) == {"aa", "bb", "cc"} and model.langs == sorted(model.langs)
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-5)
    got = {(r["doc_id"], r["text"]): r for r in
           G.identify(docs, model).join(docs.select("doc_id", "text", "lang"), "doc_id").collect()}
    for (i, text), r in got.items():
        if text is not None and len(text) > 10_000:
            assert r["lang_pred"] == "aa"
            continue
        want = plain_judge(text, model)
        if isinstance(want, tuple):
            assert (r["lang_pred"], r["score"], r["rejected"]) == (*want, True)
        else:
            assert abs(r["score"] - min(max(want), 1)) < 1e-4
            assert r["lang_pred"] in {model.langs[k] for k, s in enumerate(want) if s >= max(want) - 1e-4}
        if r["lang"] is not None and r["lang_pred"] != "und":
            assert r["lang_pred"] == r["lang"]


def test_clusters_are_nearest_means():
    rng = np.random.default_rng(3)
    base = np.eye(4, 50, dtype=np.float32)
    x = G.unit((np.repeat(base, 30, axis=0) + rng.normal(0, .05, (120, 50))).astype(np.float32))
    c, of = G.clusters(x)
    assert len(c) <= 4 and ((x @ c.T).argmax(1) == of).all()
    for j in range(len(c)):
        assert np.allclose(c[j], G.unit(x[of == j].sum(0, keepdims=True))[0], atol=1e-4)
    assert len(G.clusters(x[:1])[0]) == 1


def test_rejection_is_by_distance(fitted):
    docs, model = fitted
    odd = docs.sparkSession.createDataFrame([(1, "日本語 日本語"), (2, "zzzz xxxx"), (3, corpus()[0][1])],
                                            "doc_id long, text string")
    got = {r["doc_id"]: r for r in G.identify(odd, model, unknown="und").collect()}
    assert got[1]["rejected"] and got[2]["rejected"] and got[1]["lang_pred"] == "und"
    assert not got[3]["rejected"] and got[3]["lang_pred"] == corpus()[0][2]
    assert all(r["lang_pred"] in SYLLABLES for r in G.identify(odd, model).collect())


def test_odd_tables(spark, fitted):
    docs, _ = fitted
    out = G.classify(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    assert out.count() == docs.count()
    assert G.classify(docs.limit(0)).count() == 0
    unlabelled = G.classify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in unlabelled.collect()} == {("und", 0.0)}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(G, "LANGUAGES", 2)
        with pytest.raises(ValueError):
            G.train(docs)


def test_sample_is_bounded_and_learns_nothing_held_out(spark):
    rows = [(k, "ka lo mi " * (1 + k % 5) + str(k), "aa") for k in range(4000)]
    rows += [(k, "ungheit " * 3, "bb") for k in range(4000, 4040)] + [(9991, "que ción", "cc")] * 3000
    docs = frame(spark, rows)
    kept = G._sample(docs, 100)
    sizes = {r["lang"]: r["count"] for r in kept.groupBy("lang").count().collect()}
    assert 100 <= sizes["aa"] < 400 and sizes["bb"] == 40 and sizes["cc"] == 3000
    model = G.train(docs, bound=100)
    assert set(model.langs) == {"aa", "bb", "cc"}
    hidden = docs.withColumn("lang", F.when(~held_out(F.col("doc_id"), 4, 2), F.col("lang")))
    again = G.train(hidden, bound=100)
    assert np.array_equal(model.centroids, again.centroids) and np.array_equal(model.idf, again.idf)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op12_language_id"](spark, sf).join(truth, "doc_id").filter("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.98
