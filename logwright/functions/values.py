"""Value normalization and validation.

Staged values pass through CSV, where an empty field reads as NULL; the
helpers below give the same result directly on the parsed strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
BLOCK_PREFIX = "blk_"
DASH = "-"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
# An INET value may carry a mask length.
IPV4_PATTERN = rf"^{_V4}(?:/(?:3[0-2]|[12]?[0-9]))?\z"
# ---------------------------------------------------------------------------


def empty_to_null(c: Column) -> Column:
    """Empty text -> NULL (what a CSV round trip does to an empty field)."""
    return F.nullif(c, F.lit(""))


def dash_to_null(c: Column) -> Column:
    """``-`` or empty -> NULL (referrer, size)."""
    return F.nullif(F.nullif(c, F.lit(DASH)), F.lit(""))


def size_value(c: Column) -> Column:
    """Size field: ``-``/empty -> NULL, else a BIGINT (NULL if not a number)."""
    return dash_to_null(c).try_cast("bigint")


def block_value(c: Column) -> Column:
    """``blk_-16`` -> -16; NULL if the rest is not a BIGINT (``blk_1-2``)."""
    return F.regexp_replace(c, F.lit("^" + BLOCK_PREFIX), F.lit("")).try_cast("bigint")


def int_value(c: Column) -> Column:
    return empty_to_null(c).try_cast("int")


def host_part(c: Column) -> Column:
    """``10.2.1.7:50010`` -> ``10.2.1.7`` (text before the first colon)."""
    return F.substring_index(c, ":", 1)


def _is_ipv6(c: Column) -> Column:
    """Eight hex groups, or at most seven with one ``::`` run.

    A dotted quad at the end stands for two groups; groups are counted, so both sides
    of ``::`` together stay below eight."""
    g = "[0-9A-Fa-f]{1,4}"
    body = F.regexp_replace(c, r"/(?:12[0-8]|1[01][0-9]|[1-9]?[0-9])\z", "")
    six = F.regexp_replace(body, rf"(?<=:){_V4}\z", "0:0")
    return (six.rlike(rf"^(?:{g}:){{7}}{g}\z")
            | (six.rlike(rf"^(?:{g}(?::{g})*)?::(?:{g}(?::{g})*)?\z")
               & (F.regexp_count(six, F.lit(g)) <= 7)))


def is_ip(c: Column) -> Column:
    """True when ``c`` is a literal IPv4 or IPv6 address, with or without mask length."""
    return c.rlike(IPV4_PATTERN) | (c.contains(":") & _is_ipv6(c))
