"""Regex capture helpers that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator placed between captures; a line that already contains it takes
# the per-group extraction path instead, so the result is always exact.
SEP = "\u0001"


def regex_groups(line: Column, pattern: str, n_groups: int) -> Column:
    """``array<string>`` of the ``n_groups`` captures of ``pattern``, or NULL.

    ``pattern`` must be anchored at the start (``^``). The first match is
    found with a single regex evaluation per row: the whole line is
    rewritten to ``SEP g1 SEP g2 ...`` and split, instead of evaluating the
    regex once per group with ``regexp_extract``. A group that did not take
    part in the match yields ``''`` (as ``regexp_extract`` does). Appending
    ``[\\s\\S]*`` cannot change which path a backtracking engine takes first,
    so captures equal those of the bare pattern.
    """
    whole = "(?:" + pattern + r")[\s\S]*"
    template = "".join(SEP + "$" + str(i) for i in range(1, n_groups + 1))
    rewritten = F.regexp_replace(line, F.lit(whole), F.lit(template))
    fast = F.when(F.startswith(rewritten, F.lit(SEP)),
                  F.slice(F.split(rewritten, SEP, -1), 2, n_groups))
    exact = F.when(line.rlike(pattern), F.array(
        *[F.regexp_extract(line, pattern, i) for i in range(1, n_groups + 1)]))
    return F.when(F.instr(line, SEP) > 0, exact).otherwise(fast)
