"""Classifiers, tokenizer, neighbours, urls, chats; the pipeline's stages."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from logwright.llm import chat_trees, neighbours, piece_bpe, quality_model, queries, toxicity, url_rules
from logwright.llm.runtime import Shield

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model():
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_equal_library(spark, model):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(1)
    parts = list(" ▁ab\n\t\x00éßth日\U0001f600<0x>/s1238.,  �") + ["the", " of", "</s>", "<0x0A>", "ing"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += ["", " ", "x" * 5000, "ab " * 20000, "\n" * 50, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in piece_bpe.encode_digests(df, model).collect()}
    for k, t in enumerate(texts):
        ids = lib.encode(t or "") + [lib.eos_id()]
        assert got[k] == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids))), t
    few = df.filter("doc_id % 40 = 0 OR text IS NULL").withColumn("decoded", df.text)
    back = piece_bpe.decode_ids(piece_bpe.encode_texts(few, model), model).collect()
    assert all(r["decoded"] == lib.decode(r["piece_ids"]) and r["piece_ids"] == lib.encode(r["text"] or "") + [2]
               for r in back)
    assert piece_bpe.encode_digests(df.limit(0), model).count() == 0


def _auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("name,label,low", [("op9_quality_classifier", "quality", 0.99), ("op3_toxicity", "toxic", 0.95)])
def test_held_out_rows_are_classified(spark, name, label, low):
    got = queries.QUERIES[name](spark, BIG)
    marks = spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", label)
    rows = got.join(marks, "doc_id").filter("held_out").collect()
    y, p = np.array([r[label] for r in rows]), np.array([r["score"] for r in rows])
    assert _auc(y, p) > low and ((p >= 0.3) == y).mean() > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert got.count() == spark.read.parquet(f"{BIG}/documents.parquet").count()


@pytest.mark.parametrize("op,label", [(quality_model, "quality"), (toxicity, "toxic")])
def test_classifier_edges(spark, op, label):
    docs = spark.createDataFrame([(1, "good words here, and more"), (2, ""), (3, None), (None, "x y"), (1, "again"),
                                  (5, "long " * 50000)], "doc_id long, text string").withColumn("score", pa_lit())
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (5, 0), (9, 1)], f"doc_id long, {label} int")
    for marks in (none, odd):
        rows = op.classify(docs, marks).collect()
        assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    assert op.classify(docs.limit(0), odd).count() == 0


def pa_lit():
    from pyspark.sql import functions as F
    return F.lit("a column of the same name")


def test_scores_depend_on_text_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    m = toxicity.train(docs, marks)
    texts = pa.array([r["text"] for r in docs.limit(50).collect()])
    whole = toxicity.score_batch(texts, *m)
    assert np.allclose(whole, [toxicity.score_batch(texts.slice(k, 1), *m)[0] for k in range(50)])
    x = quality_model.statistics(texts)
    assert np.allclose(x, np.concatenate([quality_model.statistics(texts.slice(k, 1)) for k in range(50)]))


def test_trees_separate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, len(quality_model.NAMES))).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = quality_model.fit(x[:2000], y[:2000])
    assert ((t.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97


# --- neighbours -----------------------------------------------------------------

def _nearest(ids, x, every, top):
    n = np.linalg.norm(x, axis=1)
    out = {}
    for k, i in enumerate(ids):
        if i % every == 0:
            c = x @ x[k] / n / n[k]
            order = sorted((j for j in range(len(ids)) if j != k), key=lambda j: (-c[j], ids[j]))[:top]
            out[i] = [(ids[j], c[j]) for j in order]
    return out


def test_neighbours_recall_and_ties(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24))
    x[700:900] = x[700]  # copies tie
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("bucket", pa_lit())
    want = _nearest(list(range(1500)), x, 50, 5)
    for block in (4096, 64):
        monkeypatch.setattr(neighbours, "BLOCK", block)
        monkeypatch.setattr(neighbours, "QUERY_BLOCK", max(2, block // 32))
        got = {}
        for r in neighbours.nearest(df).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert sorted(got) == sorted(want)
        hits = 0
        for q, found in got.items():
            found.sort()
            assert [f[0] for f in found] == [1, 2, 3, 4, 5]
            assert all(abs(f[2] - x[q] @ x[f[1]] / np.linalg.norm(x[q]) / np.linalg.norm(x[f[1]])) < 1e-12 for f in found)
            hits += len({f[1] for f in found} & {w[0] for w in want[q]})
        assert hits >= 0.9 * 5 * len(want)
        assert [f[1] for f in got[750]] == [700, 701, 702, 703, 704]


def test_neighbours_search_is_the_same_on_either_side_of_a_size(spark, monkeypatch):
    """Tables above BLOCK x width rows are searched as smaller ones are: here 16 x 64 < 1500."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 24))[rng.integers(0, 60, 1500)] + 0.2 * rng.normal(size=(1500, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    plans, hashed = [], neighbours._hashed
    monkeypatch.setattr(neighbours, "_hashed", lambda v, plan, p: plans.append(dict(plan)) or hashed(v, plan, p))
    got = []
    for block in (4096, 16):
        monkeypatch.setattr(neighbours, "BLOCK", block)
        got.append(sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df).collect()))
    assert plans[0] == plans[-1] and got[0] == got[1]


def test_neighbours_recall_on_a_given_table(spark):
    rows = spark.read.parquet(f"{BIG}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows], float)
    want = _nearest([r["vec_id"] for r in rows], x, neighbours.EVERY, neighbours.TOP)
    found = {(r["query_id"], r["vec_id"]) for r in queries.QUERIES["op4_nearest_neighbours"](spark, BIG).collect()}
    recall = np.mean([(q, i) in found for q, near in want.items() for i, _ in near])
    print(f"recall {recall:.4f} of {sum(map(len, want.values()))}, {len(rows)} rows")
    assert recall >= 0.9


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (50, [1.0, 1.0, 1.0]), (1, [2.0, 0.0]),
            (100, [1e200, 1e200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in neighbours.nearest(df).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 100), (0, 3, 2), (100, 1, 0), (100, 2, 1), (100, 3, 2)]
    assert got[0][3] == 1.0 and abs(got[3][3] - 2 ** -0.5) < 1e-12
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_hadamard_rotation_keeps_lengths():
    x = neighbours.unit(np.random.default_rng(3).normal(size=(50, 20)))
    y = neighbours.rotated(x, 2, 0)[:, :32]
    assert np.allclose((y * y).sum(axis=1), 1)
    assert np.allclose(y @ y.T, x @ x.T)


# --- urls -------------------------------------------------------------------------

def test_url_rules(spark):
    urls = ["http://x.com/a", "http://x.com", "https://Example.COM/en/1", "https://a.example.com/en/x",
            "https://www.example.com/en/x", "https://m.www.example.com/en/", "http://notexample.net/es/1", "http://net/fr/",
            "http://a.org/adult/x/gallery", "http://free-bets.org/", "http://a.free-bets.org", "http://xfree-bets.org/",
            "http://a.net/q?u=http://free-bets.org/", None, "", "://", "nothing", "http://É.com/en/",
            "http://ads.a.org/banner/1", "http://a.org/popunder.js", "http://a.org/popunder.jsx"]
    rows = [(k, u, "<html>", "mine") for k, u in enumerate(urls)] + [(None, urls[9], "", "x"), (1, urls[1], "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    got = url_rules.judge_pages(df)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] and got.count() == len(rows)
    by = {r["page_id"]: tuple(r)[1:] for r in got.collect()}
    rule = [by[k][2:] for k in range(len(urls))]
    assert rule == [("com/", "allow"), (None, "allow"), ("example.com/en/", "block"), ("example.com/en/", "block"),
                    ("www.example.com/en/", "allow"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
                    ("net/fr/", "block"), (None, "block"), (None, "block"), (None, "block"), (None, "allow"),
                    (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
                    ("com/", "allow"), (None, "block"), (None, "block"), (None, "allow")]
    assert by[2][:2] == ("example.com", "/en/1") and by[13][:2] == ("", "") and by[17][0] == "É.com"
    assert url_rules.judge_pages(df.limit(0)).count() == 0


def test_only_ascii_letters_are_folded(spark):
    urls = ["http://A.ORG/TRACK/CLICK?x", "http://a.org/trac\u212a/click?x", "http://a.org/V\u0130AGRA/", "http://A.ORG/VIAGRA/",
            "http://ok.org/" + "x/" * 200_000 + "viagra/", "http://ok.org/" + "x/" * 200_000]
    df = spark.createDataFrame([(k, u) for k, u in enumerate([*urls, *[None] * 300])], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge_pages(df).collect()}
    assert [got[k] for k in range(6)] == ["block", "allow", "allow", "block", "block", "allow"]
    assert len(got) == 306 and {got[k] for k in range(6, 306)} == {"allow"}


def test_patterns_are_found_by_their_rarest_token(spark):
    import re
    rng = random.Random(4)
    hosts = ["free-bets.a.org", "b.casino", "adult-x.net", "ads.q.org", "ok.org"]
    paths = ["/track/click?x", "/adult/1/gallery", "/viagra", "/popunder.js", "/banner", "/x"]
    urls = sorted({f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(60)})
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    patterns = (*url_rules.PATTERNS, "*banner*", "*.org/x|")  # without a literal token
    assert url_rules.tokens_of("*banner*") == [] and url_rules.tokens_of("||ads.*/banner^") == ["ads", "banner"]
    got = {r["url"] for r in url_rules.blocked_urls(df, patterns).collect()}
    want = {u for u in urls for p in patterns if re.search(url_rules.regex_of(p), u)}
    assert got == want and want


# --- chats --------------------------------------------------------------------------

def test_template_reads_back():
    rng = random.Random(2)
    bits = ["<", "|", "im_start", "|>", "<|im_end|>", "\\", "\n", "</s>", "[INST]", "<s>", "a", "é", "<<SYS>>", "["]
    for _ in range(4000):
        turns = [("".join(rng.choices(bits, k=rng.randint(0, 4))), "".join(rng.choices(bits, k=rng.randint(0, 9))))
                 for _ in range(rng.randint(0, 4))]
        text, spans = chat_trees.format_turns(turns + [("assistant", "".join(rng.choices(bits, k=5)))])
        back = chat_trees.read_back(text)
        assert back[:-1] == turns and chat_trees.unescape(text[slice(*spans[-1])]) == back[-1][1]
        assert all(c not in chat_trees.escape(t) for _, t in turns for c in chat_trees.CONTROLS)


def test_tree_paths_and_branches(spark):
    # 1 -> (2 -> 4, 3 -> (5, 6)); 7 is a root whose parent is missing
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 2.0),
            (1, 4, 2, "user", "c", 5.0), (1, 5, 3, None, None, 4.0), (1, 6, 3, "user", "e", 4.0),
            (1, 7, 99, "user", "solo", None), (None, 1, None, "user", "n", 0.0), (1, 6, 3, "user", "e", 4.0)]
    df = spark.createDataFrame(rows, "conv_id long, msg_id long, parent_id long, role string, text string, score double") \
        .withColumn("key", pa_lit()).withColumn("leaf", pa_lit())
    got = {(r["conv_id"], r["leaf"]): r for r in chat_trees.format_trees(df, top=None).collect()}
    assert sorted(got, key=str) == [(1, 4), (1, 5), (1, 6), (1, 7), (None, 1)]
    assert chat_trees.read_back(got[1, 6]["formatted"]) == [("user", "q"), ("assistant", "b"), ("user", "e")]
    assert chat_trees.read_back(got[1, 5]["formatted"])[-1] == ("", "") and got[1, 6]["score"] == 6.0
    best = chat_trees.format_trees(df, top=2).collect()
    assert sorted((r["conv_id"] or 0, r["leaf"]) for r in best) == [(0, 1), (1, 4), (1, 5)]
    assert chat_trees.format_trees(df.limit(0)).count() == 0
    ring = spark.createDataFrame([(1, 1, 2, "user", "x", 0.0), (1, 2, 1, "user", "y", 0.0)], df.drop("key", "leaf").schema)
    with pytest.raises(ValueError, match="cycle"):
        chat_trees.format_trees(ring).count()


def test_messages_without_an_id_are_leaves(spark):
    rows = [(1, 1, None, "user", "q", 1.0), (1, None, 1, "assistant", "a", 2.0), (1, None, 1, "assistant", "b", 0.0),
            (1, None, 1, "assistant", "b", 0.0), (2, None, None, "user", "alone", 0.0), (3, 1, None, "user", "r", 0.0),
            (3, 2, 1, "assistant", "s", 1.0), (3, None, 1, "assistant", "t", 1.0), (4, None, 77, "user", "lost", None)]
    df = spark.createDataFrame(rows, "conv_id long, msg_id long, parent_id long, role string, text string, score double") \
        .repartition(4)
    got = [(r["conv_id"], r["leaf"], r["score"], [t for _, t in chat_trees.read_back(r["formatted"])])
           for r in chat_trees.format_trees(df, top=None).collect()]
    assert sorted(got, key=str) == sorted([
        (1, None, 3.0, ["q", "a"]), (1, None, 1.0, ["q", "b"]), (1, None, 1.0, ["q", "b"]), (2, None, 0.0, ["alone"]),
        (3, 2, 1.0, ["r", "s"]), (3, None, 1.0, ["r", "t"]), (4, None, 0.0, ["lost"])], key=str)
    best = {r["conv_id"]: r["leaf"] for r in chat_trees.format_trees(df, top=1).collect()}
    assert best == {1: None, 2: None, 3: 2, 4: None}


def test_linear_conversations(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(77)]
    rows += [(2, 1, "user", None), (2, None, None, "first"), (2, 1, "user", "twice"), (2, 1, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv_id"]: chat_trees.read_back(r["formatted"])
           for r in chat_trees.format_trees(chat_trees.linear(df)).collect()}
    assert got[1] == [(r, t) for _, _, r, t in rows[:77]]
    assert got[2] == [("", "first"), ("user", ""), ("user", "twice"), ("user", "twice")]


# --- pipeline -------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", pa_lit()).withColumn("row", pa_lit())
    odd = spark.createDataFrame([(None, None, None, None, None, "s", "r"), (10 ** 9, "", "en", "src0", 0, "s", "r")],
                                docs.schema)
    docs = docs.unionByName(odd)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        kept = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert set(kept) <= ids and len(kept) <= before
        before, docs = len(kept), spark.createDataFrame(out.collect(), out.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_returns_the_token_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["some words <|endoftext|> and more", "x y " * 3000, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).orderBy("doc_id", "piece").collect()
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).extend(range(r["offset"], r["offset"] + len(r["ids"])))
    assert all(sorted(at) == list(range(len(at))) and len(at) <= 1024 for at in seqs.values())
    for k, t in enumerate(texts):
        got = [i for r in rows if r["doc_id"] == k for i in r["ids"]]
        assert got == tok.encode(t or "", add_special_tokens=False).ids + [2]


def test_pipeline_run_keeps_what_plain_python_keeps(spark, monkeypatch, tmp_path):
    """run() over a small table: ids kept after each stage, and the final ids, by plain Python."""
    import public_tokenizers
    from test_text_ops import WORD, brute_dedup, brute_links, brute_rules
    from tokenizers import Tokenizer
    rng = random.Random(13)
    make = lambda n: [f"{rng.choice('abcdefgh')}{rng.randrange(900)}" for _ in range(n)]
    base, passage = make(120), make(30)
    texts = [" ".join(make(80)) for _ in range(12)]
    texts += [" ".join([*base[:k], "other", *base[k + 1:]]) for k in (20, 50, 90)]  # near copies
    texts += [" ".join(make(40) + passage + make(40)) for _ in range(4)]  # a shared passage
    texts += [texts[2], "few words", "p q r s t " * 20, "", "bad " + " ".join(make(60)), "bad " + " ".join(make(60)),
              "<|endoftext|> " + " ".join(make(60))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")

    bad = lambda t: t.startswith("bad ")
    from pyspark.sql import functions as F
    monkeypatch.setattr(quality_model, "train", lambda *a, **k: None)
    monkeypatch.setattr(quality_model, "score", lambda d, m: d.withColumn(
        "score", F.when(F.col("text").startswith("bad "), 0.0).otherwise(1.0)))
    seen, keep = {}, corpus_pipeline.written
    monkeypatch.setattr(corpus_pipeline, "written", lambda d, name: seen.setdefault(name, keep(d, name)))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = lambda name: sorted(r["doc_id"] for r in seen[name].collect())
    left = [k for k, t in enumerate(texts) if not bad(t)]
    assert ids("quality_classifier") == left
    judged = brute_rules([texts[k] for k in left], ["s"] * len(left))
    left = [k for k, w in zip(left, judged) if w[-1]]
    assert ids("quality_rules") == left
    _, group = brute_links([texts[k] for k in left])
    left = [k for n, k in enumerate(left) if group[n] == n]
    assert ids("near_duplicates") == left
    cut = brute_dedup([texts[k] for k in left], left)
    assert ids("substring_duplicates") == [k for k, (n, w) in zip(left, cut) if w or not n]
    assert any(0 < len(w) < n for n, w in cut) and len(left) < len(texts) - 6
    final = {r["doc_id"]: r["text"] for r in seen["substring_duplicates"].collect()}
    assert [WORD.findall(final[k]) for k in left] == [w for _, w in cut]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        got.setdefault(r["doc_id"], []).extend(r["ids"])
    assert got == {k: tok.encode(t, add_special_tokens=False).ids + [2] for k, t in final.items()}


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_shield_restores(spark):
    df = spark.createDataFrame([(1, "abc", 3, "x")], "doc_id long, text string, n_chars int, row string")
    s = Shield(df, "doc_id")
    assert s.restore(s.inner).collect() == df.collect()
