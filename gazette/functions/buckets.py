"""Deterministic hash buckets.

``bucket(x, n, salt)`` maps a key to ``0..n-1`` the same way in every engine:
the first 15 hex digits of ``md5(text)`` read as a non-negative 60-bit
integer, modulo ``n``.  The text is ``cast(x as string)``, followed by
``':' || salt`` when a salt is given.  Portable across Spark and DuckDB, so
derived dimensions are identical wherever they are recomputed; the checks
restate the rule in their own SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key_text(x, salt: str | None) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    txt = x.cast("string")
    if salt is not None:
        txt = F.concat(txt, F.lit(":" + salt))
    return txt


def hash60(x, salt: str | None = None) -> Column:
    return F.conv(F.substring(F.md5(_key_text(x, salt)), 1, 15), 16, 10).cast("long")


def bucket(x, n: int, salt: str | None = None) -> Column:
    """Bucket in ``[0, n)``; NULL key -> NULL bucket."""
    return F.pmod(hash60(x, salt), F.lit(n).cast("long"))


def pick(values: list, idx: Column) -> Column:
    """0-based lookup into a literal list (``GET(ARRAY_CONSTRUCT(...), i)``)."""
    return F.get(F.array(*[F.lit(v) for v in values]), idx.cast("int"))
