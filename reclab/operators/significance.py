"""Is one set of recommendations better than another, or lucky in its users?

Paired Poisson bootstrap in one pass: in replicate ``b`` a user counts
``w(user, b)`` times, where the weights are Poisson(1) numbers derived from
md5 hashes of the user and the replicate.  Nothing is resampled or collected:
a user's row gives its weighted sums to every replicate, and partial
aggregation leaves one row per replicate and task.  Both sides of a pair share
the weights, and since weights come from hashes any engine can repeat them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weight w where the hash of 32 bits is at least the w-th of these:
#: floor(2^32 * P(Poisson(1) < w)), until the 32 bits run out.
STEPS = tuple(v for v in (
    math.floor(2**32 * sum(math.exp(-1) / math.factorial(i) for i in range(w))) for w in range(1, 14))
    if v < 2**32)


def weight(hash32: Column) -> Column:
    """Poisson(1) number of a 32-bit hash (by inversion)."""
    w = F.lit(0)
    for step in STEPS:
        w = w + (hash32 >= F.lit(step)).cast("int")
    return w


def replicates(pairs: DataFrame, n: int = 200, user_col: str = "user", a: str = "a", b: str = "b",
               seed: str = "") -> DataFrame:
    """(replicate, weight, sum_a, sum_b) of every replicate 0..n-1.

    ``pairs`` has one row per user with a metric under both sides; rows where
    either is null or NaN take no part.  One md5 gives four replicates their
    32 bits, so a user costs n / 4 hashes and no exchange."""
    both = pairs.select(F.col(user_col).cast("string").alias("_u"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    for side in ("_a", "_b"):
        both = both.where(F.col(side).isNotNull() & ~F.isnan(F.col(side).cast("double")))
    text = F.concat_ws(":", F.lit(seed), "_u", F.col("_block").cast("string"))
    hashed = (both.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // 4))))
              .withColumn("_h", F.md5(text)))
    word = F.conv(F.substring(F.col("_h"), F.col("_part") * 8 + 1, F.lit(8)), 16, 10).cast("long")
    each = (hashed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(3))))
            .withColumn("replicate", (F.col("_block") * 4 + F.col("_part")).cast("int"))
            .where(F.col("replicate") < n).withColumn("_w", weight(word)).where(F.col("_w") > 0))
    return each.groupBy("replicate").agg(F.sum("_w").alias("weight"), F.sum(F.col("_w") * F.col("_a")).alias("sum_a"),
                                         F.sum(F.col("_w") * F.col("_b")).alias("sum_b"))


def compare(pairs: DataFrame, n: int = 200, level: float = 0.95, user_col: str = "user", a: str = "a", b: str = "b",
            seed: str = "", digits: int | None = 6) -> DataFrame:
    """One row: users, mean of a, of b and of their difference b - a, the
    ``level`` interval of the difference over the replicates, and the two-sided
    share of replicates that contradict its sign (1 where there is none)."""
    def r(c):
        return F.round(c, digits) if digits is not None else c

    good = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()
                       & ~F.isnan(F.col(a).cast("double")) & ~F.isnan(F.col(b).cast("double")))
    whole = good.agg(F.count(F.lit(1)).alias("n_users"), F.avg(a).alias("_ma"), F.avg(b).alias("_mb"),
                     F.avg(F.col(b) - F.col(a)).alias("_md"))
    d = (F.col("sum_b") - F.col("sum_a")) / F.col("weight")
    cut = math.floor(n * (1 - level) / 2)
    diffs = (replicates(pairs, n, user_col, a, b, seed).select(d.alias("d"))
             .withColumn("p", F.row_number().over(Window.orderBy("d"))))  # n rows, whatever the input
    ends = diffs.agg(F.count(F.lit(1)).alias("n_replicates"),
                     F.min(F.when(F.col("p") > cut, F.col("d"))).alias("_lo"),
                     F.max(F.when(F.col("p") <= F.lit(n - cut), F.col("d"))).alias("_hi"),
                     F.sum((F.col("d") <= 0).cast("long")).alias("_neg"),
                     F.sum((F.col("d") >= 0).cast("long")).alias("_pos"))
    total = F.col("n_replicates")
    return (whole.withColumn("_k", F.lit(1)).join(ends.withColumn("_k", F.lit(1)), "_k")
            .select("n_users", "n_replicates", r(F.col("_ma")).alias("mean_a"), r(F.col("_mb")).alias("mean_b"),
                    r(F.col("_md")).alias("mean_diff"), r(F.col("_lo")).alias("diff_low"),
                    r(F.col("_hi")).alias("diff_high"),
                    r(F.least(F.lit(1.0), 2 * F.least("_neg", "_pos") / total)).alias("p_value")))
