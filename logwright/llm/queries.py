"""Registered queries of the subpackage: one per operator, and the pipeline."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (chat_trees, infill, language, line_rules, neighbours, ngram_join, packing, periodic_runs, piece_bpe,
               quality_model, substring_dedup, toxicity, url_rules)
from .runtime import prepare, table

QUERIES: dict = {}
ORACLE: dict = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op7_sentencepiece")
def op7(spark, sf_dir):
    return piece_bpe.encode_digests(table(spark, sf_dir, "documents"),
                                    _tokenizer("piece_bpe_32k.model"))


@_query("op6_best_fit_packing")
def op6(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  _tokenizer("byte_bpe_50k.json"), added_tokens=True)


@_query("op3_toxicity")
def op3(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op9_quality_classifier")
def op9(spark, sf_dir):
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(source, '') AS host, text,
    coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
raw_lines AS (
  SELECT row_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (
  SELECT *, translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT row_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY row_id),
hosts AS (SELECT host, count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS documents
  FROM d GROUP BY host),
flagged AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT t) AS n FROM lines GROUP BY host, norm) x
  JOIN hosts USING (host) WHERE n * 100 > greatest(__FLOOR__ * 100, documents * __SHARE__)),
removed AS (
  SELECT row_id, sum(n) AS gone FROM lines JOIN flagged USING (host, norm) GROUP BY row_id),
pos AS (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (
  SELECT row_id, i, count(*) OVER (PARTITION BY row_id, array_to_string(w[i:i + 4], ' ')) AS c
  FROM pos WHERE i + 4 <= len(w)),
covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n_repeat_words
  FROM win, range(0, 5) AS r(k) WHERE c > 1 GROUP BY row_id),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(w) - coalesce(gone, 0) AS BIGINT) AS left_words
  FROM d LEFT JOIN dup USING (row_id) LEFT JOIN covered USING (row_id) LEFT JOIN removed USING (row_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, left_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND 100 * left_words >= __KEEP__ * n_words AS kept
FROM counts""".replace("__FLOOR__", str(line_rules.LINE_FLOOR)).replace(
    "__SHARE__", str(line_rules.LINE_SHARE)).replace(
    "__KEEP__", str(line_rules.KEEP_SHARE))


@_query("op10_quality_rules", _RULES)
def op10(spark, sf_dir):
    return line_rules.rules(table(spark, sf_dir, "documents"))


def _url_sql() -> str:
    q = lambda t: "'" + t.replace("'", "''") + "'"
    fits = [(h + p, v, f"(host = {q(h)} OR ends_with(host, {q('.' + h)})) AND starts_with(path, {q(p)})")
            for h, p, v in sorted(url_rules.HOST_RULES, key=lambda r: -len(r[0] + r[1]))]
    case = lambda k: "CASE " + " ".join(f"WHEN {f[2]} THEN {q(f[k])}" for f in fits) + " END"
    fold = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = " OR ".join(f"regexp_matches({fold}, {q(url_rules.regex_of(p))})" for p in url_rules.PATTERNS)
    split = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
WITH p AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '{split}', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '{split}', 2) AS path
  FROM pages)
SELECT page_id, host, path, {case(0)} AS rule,
  coalesce({case(1)}, CASE WHEN {hit} THEN 'block' ELSE 'allow' END) AS verdict
FROM p"""


@_query("op8_url_filters", _url_sql())
def op8(spark, sf_dir):
    return url_rules.judge_pages(table(spark, sf_dir, "pages"))


@_query("op4_nearest_neighbours")
def op4(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


_SAID = "</s>[INST] ok [/INST]"


def _chat_sql() -> str:
    q = lambda t: "'" + t.replace("'", "''") + "'"
    marks = "|".join(re.escape(c) for c in chat_trees.CONTROLS)
    extra = (lambda c: f"(length({c}) + length(regexp_replace({c}, '[^\\\\]', '', 'g')) "  # noqa: E731
                       f"+ len(regexp_extract_all({c}, {q(marks)})))")
    frame = len(chat_trees.START) + len(chat_trees.END) + 2
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {q(_SAID)} UNION ALL SELECT -1, 1, 'assistant', {q(_SAID)})
SELECT conv_id, COUNT(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum({frame} + {extra('role')} + length(regexp_replace(role, '[^\n]', '', 'g')) + {extra('text')}) AS BIGINT)
    AS formatted_chars
FROM c GROUP BY conv_id"""


@_query("op5_chat_trees", _chat_sql())
def op5(spark, sf_dir):
    fixed = spark.createDataFrame([(-1, 0, "user", _SAID), (-1, 1, "assistant", _SAID)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(fixed)
    return chat_trees.digests(chat_trees.format_trees(chat_trees.linear(rows), top=1))


_WORDS = """
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)"""

#: For tables with one row per id.
_JOIN_SQL = "WITH RECURSIVE" + _WORDS + """,
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0),
runs AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM starts),
marks AS (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS m FROM runs GROUP BY doc_id),
copies AS (SELECT doc_id, count(*) OVER (PARTITION BY m) - 1 AS n_copies FROM marks),
sets AS (SELECT DISTINCT doc_id, s FROM runs),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 5 * c >= 4 * (p.n + q.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
groups AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, CAST(least(d.doc_id, coalesce(g.least, d.doc_id)) AS BIGINT) AS group_id,
  CAST(coalesce(e.n, 0) AS BIGINT) AS n_links, CAST(coalesce(c.n_copies, 0) AS BIGINT) AS n_copies
FROM d LEFT JOIN groups g ON g.a = d.doc_id LEFT JOIN degrees e ON e.a = d.doc_id LEFT JOIN copies c ON c.doc_id = d.doc_id"""


@_query("op1_ngram_join", _JOIN_SQL)
def op1(spark, sf_dir):
    return ngram_join.join(table(spark, sf_dir, "documents"))


#: For tables with one row per id.
_DEDUP_SQL = "WITH" + _WORDS + """,
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM starts),
firsts AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS p, true AS g FROM win JOIN firsts USING (g), range(0, 13) AS r(k)
  WHERE doc_id > f),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""


@_query("op2_substring_dedup", _DEDUP_SQL)
def op2(spark, sf_dir):
    return substring_dedup.dedup_digests(table(spark, sf_dir, "documents"))


@_query("op11_periodic_runs")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.digests(periodic_runs.find_runs(docs, periodic_runs.planted_tail))


@_query("op12_language_id")
def op12(spark, sf_dir):
    return language.classify(table(spark, sf_dir, "documents"))


_INFILL_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS c2,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
    OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= {100 - infill.PLAIN} THEN 'plain'
  WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < {infill.SPM} THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(w[1:least(c1, c2)], '') AS a,
  array_to_string(w[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
  array_to_string(w[greatest(c1, c2) + 1:], '') AS z FROM x)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
    ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p"""


@_query("op13_fill_in_middle", _INFILL_SQL)
def op13(spark, sf_dir):
    return infill.digests(infill.fill_in_middle(table(spark, sf_dir, "documents")))


@_query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
