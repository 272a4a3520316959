"""Dense-vector arithmetic on ``ARRAY<FLOAT|DOUBLE>`` columns with higher-order
functions, so it stays inside whole-stage codegen (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    """Inner product of two equal-length arrays, accumulated in double."""
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def scale(a, factor) -> Column:
    f = _col(factor) if isinstance(factor, (str, Column)) else F.lit(factor)
    return F.transform(_col(a), lambda x: x.cast("double") * f)


def as_double_array(a) -> Column:
    return F.transform(_col(a), lambda x: x.cast("double"))
