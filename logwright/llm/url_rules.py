"""URL filters: host rules, and pattern rules indexed by their rarest literal token.

DataFrame functions only. A pattern is literal text with ``*`` (anything), ``^`` (a
character other than letters, digits, ``_ - . %``, or the end), ``|`` (start or end of
the url) and ``||`` (start of the host or of one of its labels); it matches without
regard to ASCII case. Its literal tokens are the runs of ASCII letters and digits
that any matching url must hold as whole tokens. Of these the one that is rarest
among the urls of the table is its index entry. The distinct tokens of each distinct
url fetch the rules filed under them, and only these run their regular expression.
Patterns without such a token are few by design and run on every url.

Host rules (host, path, verdict) fit a host and its subdomains if the url's path
starts with the rule's; the longest rule wins and decides before any pattern.

The rule lists are parameters held by the driver; the planner broadcasts them only
below its size limit. Null urls have an empty host and path, fit nothing and are
allowed; repeated rows each give a row; ``page_id`` may be null; urls are judged whole,
however long.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import prepare, written

#: (host, path, verdict)
HOST_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Patterns that block.
PATTERNS = ("||adult-x.", "||free-bets.", "||casino^", "||porn^", "||xxx^", "/adult/*/gallery^", "^bet-bonus^",
            "^free-pills^", "/track/click?", "^popunder.js|", "||ads.*/banner^", "^viagra^")

_SEPARATOR = r"(?:[^a-z0-9_.%\-]|$)"


def regex_of(pattern: str) -> str:
    """Regular expression (on the lower-cased url) of a pattern."""
    p, head, tail = pattern.lower(), "", ""
    if p.startswith("||"):
        p, head = p[2:], r"^[^:/?#]*://(?:[^/?#]*\.)?"
    elif p.startswith("|"):
        p, head = p[1:], "^"
    if p.endswith("|"):
        p, tail = p[:-1], "$"
    body = "".join({"*": ".*", "^": _SEPARATOR}.get(c, re.escape(c) if not c.isalnum() else c) for c in p)
    return head + body + tail


def tokens_of(pattern: str) -> list[str]:
    """Tokens that every matching url holds whole: bounded on both sides in the pattern."""
    p = pattern.lower()
    left = "start" if p.startswith("|") else "open"
    right = "end" if p.endswith("|") else "open"
    p = p.strip("|")
    out = []
    for m in re.finditer("[a-z0-9]+", p):
        before = p[m.start() - 1] if m.start() else None
        after = p[m.end()] if m.end() < len(p) else None
        if (left == "start" if before is None else before != "*") and \
                (right == "end" if after is None else after != "*"):
            out.append(m.group())
    return sorted(set(out))


def folded(c: Column) -> Column:
    """ASCII letters lower-cased, all others as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(folded(url), F.lit("([a-z0-9]+)"), F.lit(1)))


def parts(pages: DataFrame) -> DataFrame:
    """``pages`` with host (A-Z folded) and path; both empty without ``://``."""
    split = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    return (pages.withColumn("host", folded(F.regexp_extract(url, split, 1)))
            .withColumn("path", F.regexp_extract(url, split, 2)))


def host_rule(rules=HOST_RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
            for h, p, _ in ordered]
    pick = lambda k: F.coalesce(*[F.when(f, F.lit(v)) for f, v in zip(fits, k)], F.lit(None).cast("string"))
    return pick([h + p for h, p, _ in ordered]), pick([v for _, _, v in ordered])


def rule_index(urls: DataFrame, patterns=PATTERNS) -> DataFrame:
    """(token, regex): each pattern with a literal token under its rarest one in ``urls``.

    Counts cover every url; only the rules' tokens (a parameter's worth) leave a url, and they are
    added up by partial sums before any join.
    """
    spark = urls.sparkSession
    known = sorted({t for p in patterns for t in tokens_of(p)})
    filed = spark.createDataFrame([(p, t) for p in sorted(set(patterns)) for t in tokens_of(p)],
                                  "pattern string, token string")
    regexes = spark.createDataFrame([(p, regex_of(p)) for p in sorted(set(patterns))],
                                    "pattern string, regex string")
    wanted = F.array_intersect(_tokens(F.col("url")), F.array(*[F.lit(t) for t in known]).cast("array<string>"))
    counts = (urls.filter(F.col("url").isNotNull()).select(F.explode(wanted).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    return (filed.join(counts, "token", "left")
            .groupBy("pattern").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
            .join(regexes, "pattern").select("token", "regex"))


def blocked_urls(pages: DataFrame, patterns=PATTERNS) -> DataFrame:
    """Distinct urls that a pattern blocks.

    The index is written first, so the planner knows its size when it plans the join.
    """
    index = written(rule_index(pages, patterns), "rules")
    urls = pages.select("url").filter(F.col("url").isNotNull()).distinct()
    found = (urls.select("url", F.explode(_tokens(F.col("url"))).alias("token"))
             .join(index, "token")
             .filter(F.regexp_like(folded(F.col("url")), F.col("regex"))).select("url"))
    for p in sorted(set(patterns)):
        if not tokens_of(p):  # no literal token: runs on every url
            found = found.union(urls.filter(folded(F.col("url")).rlike(regex_of(p))))
    return found.distinct()


def judge_pages(pages: DataFrame, rules=HOST_RULES, patterns=PATTERNS) -> DataFrame:
    """page_id, host, path, rule, verdict of every page row."""
    prepare(pages.sparkSession)
    pages = pages.select("page_id", "url")
    blocked = blocked_urls(pages, patterns).select(F.col("url").alias("_url"))
    rule, verdict = host_rule(rules)
    # null urls meet no key: they stay out of the join, so any number of them is no hot group
    found = parts(pages.filter(F.col("url").isNotNull())).join(blocked, F.col("url") == F.col("_url"), "left")
    none = parts(pages.filter(F.col("url").isNull())).withColumn("_url", F.lit(None).cast("string"))
    return (found.unionByName(none)
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("_url").isNotNull(), "block").otherwise("allow"))
                    .alias("verdict")))
