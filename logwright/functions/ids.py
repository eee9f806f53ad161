"""Identifier columns.

Action-type ids are name-based UUIDs (RFC 4122 version 5): the same name
always gives the same id on every executor, so no lookup or shuffle is
needed to attach an action id to a parsed row.
"""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ACTION_NAMESPACE


def uuid5(name: Column, namespace: str = ACTION_NAMESPACE) -> Column:
    """Version-5 UUID text of ``name`` under ``namespace``, built from SHA-1.

    Layout (hex digits of the digest ``h``): 8-4-4-4-12 where the version
    nibble is forced to 5 and the two top bits of the variant nibble to 10.
    """
    ns = F.unhex(F.lit(_uuid.UUID(namespace).hex))
    h = F.sha1(F.concat(ns, F.encode(name, "UTF-8")))
    variant = F.lower(F.conv(
        F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
        .cast("string"), 10, 16))
    return F.when(name.isNotNull(), F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    ))


def uuid5_py(name: str, namespace: str = ACTION_NAMESPACE) -> str:
    """Driver-side twin of :func:`uuid5` for literals and tests."""
    return str(_uuid.uuid5(_uuid.UUID(namespace), name))


def random_id() -> Column:
    """Random version-4 UUID text for a new row.

    The value is nondeterministic; materialize it once (write the table
    that carries it) before deriving several tables from the same rows.
    """
    return F.expr("uuid()")
