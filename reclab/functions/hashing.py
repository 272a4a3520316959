"""Deterministic hashing used for sampling, splits and folds.

``hash32(x)`` is the first 8 hex digits of ``md5(x)`` read as an unsigned
integer.  DuckDB computes the same value with
``('0x' || substr(md5(x), 1, 8))::BIGINT``, which is what makes every
sample and split in this library checkable by an independent SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash32(*cols, sep: str = ":") -> Column:
    """Unsigned 32-bit hash of the string form of ``cols`` joined by ``sep``."""
    parts = [_col(c).cast("string") for c in cols]
    text = parts[0] if len(parts) == 1 else F.concat_ws(sep, *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def bucket(n: int, *cols, sep: str = ":") -> Column:
    """``hash32(cols) % n``: a stable bucket in ``[0, n)``."""
    return (hash32(*cols, sep=sep) % F.lit(n)).cast("int")
