"""Joins, dedup, rules and packing against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from logwright.llm import line_rules, ngram_join, packing, substring_dedup
from logwright.llm.runtime import prepare

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, label string, kept int"


def docs_of(spark, texts, ids=None, sources=None):
    """Documents with extra columns whose names the operators use inside."""
    rows = []
    for k, t in enumerate(texts):
        i = k if ids is None else ids[k]
        rows.append((i, t, "en", None if sources is None else sources[k], None if t is None else len(t),
                     "n", "l", 0))
    return spark.createDataFrame(rows, DOCS).repartition(3)


def corpus(seed=3):
    """Copies, near copies, shared passages, short, empty, null and long texts."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage = make(60)
    out = []
    for k in range(40):
        w = make(rng.choice([3, 8, 40, 120]))
        if k % 5 == 0:
            w = w + passage + make(5)
        out.append(" ".join(w))
    base = make(150)
    for k in range(30):  # near copies
        w = list(base)
        for _ in range(k % 6):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        out.append("\n".join([" ".join(w[:70]), " ".join(w[70:])]))
    out += [out[0]] * 9 + [out[41]] * 4 + ["", "   ", None, "one", "one", "two words", "\t\n"]
    out.append(" ".join(make(30_000)))
    return out


def shingles(t):
    w = WORD.findall(t or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def brute_links(texts):
    s = [shingles(t) for t in texts]
    n = len(s)
    links = [[j for j in range(n) if j != i and s[i] and s[j] and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j])]
             for i in range(n)]
    group = list(range(n))
    for i in range(n):
        todo = [i]
        while todo:
            k = todo.pop()
            for j in links[k]:
                if group[j] > group[i]:
                    group[j] = group[i]
                    todo.append(j)
    return links, group


@pytest.mark.parametrize("block", [1024, 4])
def test_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7 if block == 4 else 10000)
    try:
        texts = corpus()
        links, group = brute_links(texts)
        got = {r["doc_id"]: r for r in ngram_join.join(docs_of(spark, texts)).collect()}
        assert [got[i]["n_links"] for i in range(len(texts))] == [len(x) for x in links]
        assert [got[i]["group_id"] for i in range(len(texts))] == group
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)


def test_join_edges(spark):
    none = docs_of(spark, [])
    assert ngram_join.join(none).count() == 0 and ngram_join.one_of_each(none).columns == none.columns
    t = "a b c d e f g"
    rows = docs_of(spark, [t, t, t, "x y z", "", None], ids=[5, 5, None, 7, 8, 9])
    got = sorted((r["doc_id"] or -1, r["group_id"], r["n_links"]) for r in ngram_join.join(rows).collect())
    assert got == [(-1, None, 0), (5, 5, 1), (5, 5, 1), (7, 7, 0), (8, 8, 0), (9, 9, 0)]
    kept = ngram_join.one_of_each(rows)
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 5, 7, 8, 9]


def test_hot_family_hides_no_hard_pair(spark):
    """Pairs at exactly 0.8 are found whatever easy pairs the table holds besides."""
    rng = random.Random(11)
    word = iter(range(10 ** 9))
    fresh = lambda: f"u{next(word)}"
    pairs, base = 1200, [fresh() for _ in range(300)]
    texts = []
    for _ in range(pairs):  # 45 shingles, 40 of them shared: 40 / 50
        w = [fresh() for _ in range(49)]
        texts += [" ".join(w), " ".join([*w[:20], fresh(), *w[21:]])]
    for _ in range(400):  # 79,800 pairs above 0.9
        k = rng.randrange(300)
        texts.append(" ".join([*base[:k], fresh(), *base[k + 1:]]))
    assert 5 * len(shingles(texts[0]) & shingles(texts[1])) == 4 * len(shingles(texts[0]) | shingles(texts[1]))
    got = {r["doc_id"]: r for r in ngram_join.join(docs_of(spark, texts)).collect()}
    assert [k for k in range(0, 2 * pairs, 2) if (got[k]["n_links"], got[k + 1]["group_id"]) != (1, k)] == []
    assert all(got[k]["n_links"] == 399 for k in range(2 * pairs, len(texts)))


def test_prefixes_shorten_to_the_target():
    missed = 1.0
    for d in ngram_join.AT:
        missed *= 1 - 0.8 ** int(d)
    assert 1 - missed >= ngram_join.TARGET
    # a step less would not do
    step = list(ngram_join.AT)
    step[max(k for k, d in enumerate(step) if d == min(step))] += 1
    missed = 1.0
    for d in step:
        missed *= 1 - 0.8 ** int(d)
    assert 1 - missed < ngram_join.TARGET
    with pytest.raises(ValueError):
        ngram_join.depths(trees=2)


def test_close_pairs_meet_at_longer_prefixes(spark):
    """Each pair is tested once, at the longest prefix that it shares."""
    texts, pairs = [], 4000
    for c in range(pairs):  # 61 of 63 shingles (0.97), or 40 of 50 (0.8)
        w = [f"c{c}w{j}" for j in range(65 if c % 2 else 49)]
        texts += [" ".join(w), " ".join([*w, "y", "z"] if c % 2 else [*w[:20], f"y{c}", *w[21:]])]
    near, hard = (len(shingles(texts[k]) & shingles(texts[k + 1])) / len(shingles(texts[k]) | shingles(texts[k + 1]))
                  for k in (2, 0))
    assert hard == 0.8 and near > 0.95
    sign = ngram_join.signed(docs_of(spark, texts))
    classes = sign.select("node", "sig")
    edges = ngram_join._edges(ngram_join.forest(classes), classes)
    kind = {bytes(r["node"]): r["doc_id"] // 2 for r in sign.collect()}
    level = {}
    for r in edges.collect():
        assert kind[bytes(r["a"])] == kind[bytes(r["b"])] not in level
        level[kind[bytes(r["a"])]] = r["level"]
    assert len(level) == pairs
    close, far = ([v for c, v in level.items() if c % 2 == odd] for odd in (1, 0))
    # no whole prefix in common: (1 - s ** DEPTH) ** TREES of the pairs
    expect = pairs / 2 * (1 - hard ** ngram_join.DEPTH) ** ngram_join.TREES
    below = sum(v < ngram_join.DEPTH for v in far)
    assert set(close) == {ngram_join.DEPTH} and expect > 5
    assert abs(below - expect) < 5 * expect ** 0.5 and min(far) >= ngram_join.AT.min()


@pytest.mark.parametrize("block", [1024, 4])
def test_groups_alone_equal_brute_force(spark, monkeypatch, block):
    """The descent that skips pairs of one group finds the same groups."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = corpus(8) + corpus(9)
    _, group = brute_links(texts)
    rows = ngram_join._placed(docs_of(spark, texts), True).collect()
    assert sorted((r["doc_id"], r["group_id"]) for r in rows) == list(enumerate(group))


def test_chains_are_one_group(spark):
    """Links hold a group together that no text of it links as a whole."""
    texts = []
    for c in range(6):  # neighbours share 88 of 104 shingles, others less than four fifths
        w = [f"c{c}w{k}" for k in range(8 * 29 + 100)]
        texts += [" ".join(w[8 * k:8 * k + 100]) for k in range(30)]
    links, group = brute_links(texts)
    assert sorted(set(group)) == [30 * c for c in range(6)] and max(map(len, links)) == 2
    got = {r["doc_id"]: r for r in ngram_join.join(docs_of(spark, texts)).collect()}
    assert [got[i]["n_links"] for i in range(len(texts))] == [len(x) for x in links]
    assert [got[i]["group_id"] for i in range(len(texts))] == group
    kept = ngram_join.one_of_each(docs_of(spark, texts)).collect()
    assert sorted(r["doc_id"] for r in kept) == [30 * c for c in range(6)]


def test_repeated_ids_are_judged_by_row(spark):
    a, b, c, d, e, f, g = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcdefg")
    rows = [(3, b), (5, a), (5, b + " z"), (6, c), (6, d), (7, e), (7, e + " z"), (7, f), (8, ""), (8, ""), (8, g),
            (8, g), (9, "g  " + d), (9, None), (None, a), (10, f)]
    df = docs_of(spark, [t for _, t in rows], [i for i, _ in rows])
    out = ngram_join.one_of_each(df)
    assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
    kept = Counter((r["doc_id"], r["text"].replace(" z", "") if r["text"] else r["text"]) for r in out.collect())
    # 5's second text is 3's, 9's first is 6's, 10's is 7's
    assert kept == Counter([(3, b), (5, a), (6, c), (6, d), (7, e), (7, f), (8, ""), (8, ""), (8, g), (9, None),
                            (None, a)])


def sha(words):
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


def brute_dedup(texts, ids):
    first, words = {}, [WORD.findall(t or "") for t in texts]
    for i, w in sorted(zip(ids, words), key=lambda x: (x[0] is None, x[0])):
        for k in range(len(w) - 12):
            if i is not None:
                first.setdefault(tuple(w[k:k + 13]), i)
    out = []
    for i, w in zip(ids, words):
        keep = [True] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k:k + 13])] < i:
                keep[k:k + 13] = [False] * 13
        out.append((len(w), [x for x, y in zip(w, keep) if y]))
    return out


@pytest.mark.parametrize("batch", [10000, 3])
def test_dedup_equals_brute_force(spark, batch):
    texts = corpus(4)
    ids = list(range(len(texts)))
    ids[7] = ids[8] = None
    ids[50] = ids[49]  # an id with two texts
    random.Random(1).shuffle(ids)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = Counter(map(tuple, substring_dedup.dedup_digests(docs_of(spark, texts, ids)).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)
    want = Counter((i, n, n - len(w), sha(w)) for i, (n, w) in zip(ids, brute_dedup(texts, ids)))
    assert got == want


@pytest.mark.parametrize("rule", ["share", "later"])
@pytest.mark.parametrize("bits", [2, 18])
def test_early_decisions_lose_nothing(monkeypatch, rule, bits):
    """Tasks with few and many slots: what they decide and what the exchange finds is the whole result."""
    monkeypatch.setattr(substring_dedup, "SEEN", bits)
    rng = np.random.default_rng(bits)
    a = rng.integers(-9, 9, 4_000)
    a[rng.random(4_000) < 0.3] = 5  # a key in a third of all rows
    b = rng.integers(0, 2, 4_000) if bits == 2 else a % 2  # keys of one slot, or of one each
    d = rng.integers(0, 300, 4_000)
    dealt, got = Counter(), set()
    exchange = {}
    for task in np.array_split(np.arange(4_000), 4):
        seen = substring_dedup._Seen()
        for part in np.array_split(task, 9):
            deal, done = seen.split(a[part], b[part], d[part], rule)
            got |= set(zip(*(x.tolist() for x in done)))
            for x, y, doc in zip(*(x.tolist() for x in deal)):
                exchange.setdefault((x, y), set()).add(doc)
                dealt[x, y] += 1
    for (x, y), have in exchange.items():
        if rule == "share":
            got |= {(x, y, doc) for doc in have if len(have) > 1}
        else:
            got |= {(x, y, doc) for doc in have if doc > min(have)}
    all_docs = {}
    for x, y, doc in zip(a.tolist(), b.tolist(), d.tolist()):
        all_docs.setdefault((x, y), set()).add(doc)
    want = {(x, y, doc) for (x, y), have in all_docs.items() for doc in have
            if (len(have) > 1 if rule == "share" else doc > min(have))}
    assert got == want
    if bits == 18:
        # one row of a key and task; "later" deals a new smallest id as well
        assert max(dealt.values()) <= (4 if rule == "share" else 36)


def test_dedup_deals_hot_keys_evenly(spark):
    """A passage that most documents share: a few rows of its anchors and windows go by their hash."""
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(30))
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(20)) + (" " + passage if k % 4 else "")
             for k in range(400)]
    df = docs_of(spark, texts)
    prepare(spark)
    found = substring_dedup.anchors(df, 13).cache()
    most = found.filter("not done").groupBy("a").count().agg({"count": "max"}).first()[0]
    assert most <= df.rdd.getNumPartitions()
    shared = {tuple(r) for r in substring_dedup.shared_anchors(found).collect()}
    assert len({i for i, _ in shared}) == 300 and {i for i, _ in shared} == {k for k in range(400) if k % 4}
    got = Counter(map(tuple, substring_dedup.dedup_digests(df).collect()))
    want = Counter((i, n, n - len(w), sha(w)) for i, (n, w) in enumerate(brute_dedup(texts, range(400))))
    assert got == want
    found.unpersist()


def test_dedup_texts(spark):
    texts = corpus(5)
    df = docs_of(spark, texts)
    out = substring_dedup.apply_dedup(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    for k, (n, w) in enumerate(brute_dedup(texts, range(len(texts)))):
        if n and not w:
            assert k not in got
        elif len(w) == n:
            assert got[k]["text"] == texts[k]
        else:
            assert WORD.findall(got[k]["text"]) == w and got[k]["n_chars"] == len(got[k]["text"])
    assert substring_dedup.apply_dedup(docs_of(spark, [])).count() == 0


def test_difference_cover():
    for v in range(1, 10):
        d = substring_dedup.cover(v)
        assert all(any((i + k) % v in d and (j + k) % v in d for k in range(v)) for i in range(v) for j in range(v))
    assert substring_dedup.shape(13) == (7, 7) and len(substring_dedup.cover(7)) == 3


def brute_rules(texts, sources):
    fold = lambda t: "".join(c.lower() if c < "\x80" else c for c in t)
    counts, sizes = {}, {}
    for t, s in zip(texts, sources):
        sizes.setdefault(s or "", set()).add(t)
        for line in (t or "").split("\n"):
            if WORD.search(line):
                counts.setdefault((s or "", " ".join(WORD.findall(fold(line)))), set()).add(t)
    out = []
    for t, s in zip(texts, sources):
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        win = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        cover = {i + j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(5)}
        limit = max(line_rules.LINE_FLOOR * 100, line_rules.LINE_SHARE * len(sizes[s or ""]))
        gone = sum(len(WORD.findall(x)) for x in lines
                   if 100 * len(counts[s or "", " ".join(WORD.findall(fold(x)))]) > limit)
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        left = len(w) - gone
        kept = not failed and 100 * left >= line_rules.KEEP_SHARE * len(w)
        out.append((len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)),
                    len(cover), failed, left, kept))
    return out


def test_rules_equal_brute_force(spark):
    rng = random.Random(6)
    texts, sources = [], []
    for k in range(90):
        body = "\n".join(" ".join(rng.choice("abcdefghij") + str(rng.randrange(60)) for _ in range(9)) for _ in range(3))
        t = body + ("\nAll  Rights Reserved.\n" if k % 2 else "") + ("\nall rights\treserved." if k % 3 == 0 else "")
        texts.append(t)
        sources.append(f"h{k % 2}" if k % 7 else None)
    texts += ["ALL rights reserved.\n" * 5, "a b c d e " * 30, "", None, "é*# |<x> " * 4, "p q r s t u v w x y z\n\n"]
    sources += ["h1"] * 6
    texts.append("\n".join(["all rights reserved."] + [" ".join(["z"] * 3)] * 2))
    sources.append("h1")
    df = docs_of(spark, texts, sources=sources)
    got = {r["doc_id"]: tuple(r)[1:] for r in line_rules.rules(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "left_words",
        "kept").collect()}
    want = brute_rules(texts, sources)
    assert [got[k] for k in range(len(texts))] == want
    assert any(not f and n > x for n, _, _, _, _, f, x, _ in want)  # some lines were removed
    out = line_rules.apply_rules(df)
    assert out.columns == df.columns
    kept = {r["doc_id"]: r for r in out.collect()}
    assert sorted(kept) == [k for k, w in enumerate(want) if w[-1]]
    for k, r in kept.items():
        assert len(WORD.findall(r["text"])) == want[k][6] and r["n_chars"] == len(r["text"])
        assert "reserved" not in r["text"].lower() or want[k][6] == want[k][0]
    assert line_rules.rules(docs_of(spark, [])).count() == 0


def test_depleted_documents_are_rejected(spark):
    """Frequent lines are removed; a document that is mostly such lines goes, the others stay."""
    rng = random.Random(9)
    own = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randrange(10_000)) for _ in range(n))
    common = [own(11) for _ in range(4)]
    texts = [own(40) + "\n" + "\n".join(common) for _ in range(30)]        # 40 of 84 words are left
    texts += ["\n".join([own(6 + k), *common]) for k in range(20)]          # 6 to 25 of 50 to 69 words
    df = docs_of(spark, texts, sources=["h"] * 50)
    got = {r["doc_id"]: r for r in line_rules.rules(df).collect()}
    want = brute_rules(texts, ["h"] * 50)
    for k, w in enumerate(want):
        assert (got[k]["left_words"], got[k]["base_failed"], got[k]["kept"]) == (w[6], w[5], w[7])
    depleted = [k for k, w in enumerate(want) if not w[7] and not w[5]]
    assert len(depleted) > 5 and min(depleted) >= 30 and any(w[7] for w in want[30:])
    assert {r["doc_id"] for r in line_rules.apply_rules(df).collect()} == {k for k, w in enumerate(want) if w[7]}


def test_plan_fills_bins():
    rng = random.Random(2)
    for _ in range(60):
        cap = rng.choice([16, 64, 1024])
        lengths = [rng.randint(1, cap) for _ in range(rng.randint(0, 300))]
        bins, ranks = {}, Counter()
        for size, first, n, base, per, offset in packing.plan(Counter(lengths), cap):
            assert ranks[size] == first
            ranks[size] += n
            for k in range(n):
                bins.setdefault(base + k // per, []).append((offset + k % per * size, size))
        assert ranks == Counter(lengths)
        for parts in bins.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= cap
        assert len(bins) <= sum(lengths) / cap * 1.25 + 2
    assert sum(k * n for k, n in packing.fullest({5: 1, 4: 2, 3: 1}, [5, 4, 3], 8).items()) == 8


def test_packed_documents(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    texts = corpus(8) + ["<|endoftext|> a", "naïve \U0001f600  x\r\n\t y don't", "\x00"]
    df = docs_of(spark, texts)
    rows = packing.pack_documents(df, path, with_ids=True).collect()
    by, seqs = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    for k, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        parts = sorted(by[k], key=lambda r: r["piece"])
        assert [i for r in parts for i in r["ids"]] == ids
        assert [r["start"] for r in parts] == [sum(x["length"] for x in parts[:j]) for j in range(len(parts))]
        assert all(r["length"] == 1024 for r in parts[1:])
    for parts in seqs.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(seqs) <= -(-total // 1024) + 1
    assert packing.pack_documents(docs_of(spark, []), path).count() == 0


def test_added_tokens_are_read_as_by_the_library(spark, tmp_path):
    """The registered query against the library's default settings."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    from logwright.llm import queries
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    rng = random.Random(12)
    texts = [mark, f"a {mark} b", f"{mark}{mark} x", f"<|{mark}|>", "<|endoftext", f"x  {mark}  \n y{mark}", "a b", None,
             "".join(rng.choice([mark, " word", "  ", "\n", "é", "<|", "don't"]) for _ in range(3000))]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    by = {}
    for r in queries.QUERIES["op6_best_fit_packing"](spark, str(tmp_path)).collect():
        by.setdefault(r["doc_id"], []).append(r)
    for k, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        parts = sorted(by[k], key=lambda r: r["piece"])
        assert (50256 in ids) == (mark in (t or "")) and sum(r["length"] for r in parts) == len(ids)
        for r in parts:
            cut = ids[r["start"]:r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in cut))


def test_likely_members_miss_none(spark, monkeypatch):
    from logwright.llm import runtime
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    ids = df.filter("doc_id % 50 = 7")
    for bits, most in ((24, 110), (8, 5000)):
        monkeypatch.setattr(runtime, "BITMAP", bits)
        got = {r["doc_id"] for r in runtime.likely_members(df, ids, "doc_id").collect()}
        assert {r["doc_id"] for r in ids.collect()} <= got and len(got) <= most
