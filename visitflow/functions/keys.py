"""Key handling: sentinel filtering and safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL = "nan"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_real_key(c, sentinel: str = SENTINEL) -> Column:
    """``x != 'nan' AND x IS NOT NULL``."""
    c = col_(c)
    return c.isNotNull() & (c != F.lit(sentinel))


def safe_cast(c, to: str = "bigint") -> Column:
    """``SAFE_CAST(x AS INT64)``: null instead of an error on bad text (F2)."""
    return col_(c).try_cast(to)


def key_string(c) -> Column:
    """``CAST(x AS STRING)`` for integral keys (F1).  Doubles are refused: a
    double prints as ``5.7E10`` and would never match a string key."""
    return col_(c).cast("string")


def canonical_long(c) -> Column:
    """String key -> bigint when the text is exactly that number's decimal
    form, else null.  ``canonical_long(s) = n`` holds exactly when
    ``CAST(n AS STRING) = s``, so a string-keyed side can join a bigint-keyed
    side on the bigint, and a whole join chain shares one hash partitioning."""
    s = col_(c)
    n = s.try_cast("bigint")
    return F.when(n.cast("string") == s, n)
