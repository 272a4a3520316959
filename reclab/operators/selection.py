"""Exact selection of the n smallest rows by a hexadecimal key, without a sort.

A histogram over the first digits of the key tells which digits the n-th
smallest row has; the digits are refined inside that one bucket until it is
small, and the n-th row itself is taken from there.  The rows wanted are then
those up to a known boundary: a filter, with no exchange and no written copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits by which a round refines: 16^4 counts at most reach the driver.
DIGITS = 4
#: A bucket of at most so many rows is ordered by one task.
LEAF = 10_000


def _histogram(rows: DataFrame, key: Column, digits: int) -> list[tuple[str, int]]:
    return sorted((r["d"], r["n"]) for r in rows.groupBy(
        F.substring(key, 1, digits).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect())


def smallest(rows: DataFrame, key: Column, tie: str, n: int | None = None, fraction: float | None = None,
             digits: int = DIGITS, leaf: int = LEAF) -> DataFrame:
    """The ``n`` rows (or ``round(fraction * rows)`` of them) first in
    ``(key, tie)`` order; ``key`` holds lower-case hexadecimal text, ``tie`` is
    a column that tells rows of equal keys apart.  Null keys come first.  With
    fewer rows than ``n`` all are returned; rows equal in both stay together.

    ``rows`` is read twice to find the boundary (once more for each further
    ``digits`` that a bucket of over ``leaf`` rows needs) and must give the same
    rows each time.
    """
    if (fraction is None) == (n is None):
        raise ValueError("give exactly one of fraction and n")
    key = F.coalesce(key, F.lit(""))
    depth = digits
    counts = _histogram(rows, key, depth)
    total = sum(c for _, c in counts)
    if n is None:
        n = int(round(total * fraction))
    if n >= total:
        return rows
    if n <= 0:
        return rows.limit(0)
    below = 0
    while True:
        for prefix, count in counts:
            if below + count >= n:
                break
            below += count
        inside = rows.where(F.substring(key, 1, depth) == prefix)
        if count <= leaf or len(prefix) < depth:  # small, or the keys end here
            break
        depth += digits
        counts = _histogram(inside, key, depth)
    last = (inside.select(key.alias("k"), F.col(tie).alias("t")).orderBy("k", "t").limit(n - below)
            .agg(F.max(F.struct("k", "t")).alias("m")).first()["m"])
    tie_type = rows.schema[tie].dataType
    bound = F.struct(F.lit(last["k"]).alias("k"), F.lit(last["t"]).cast(tie_type).alias("t"))
    return rows.where(F.struct(key.alias("k"), F.col(tie).alias("t")) <= bound)
