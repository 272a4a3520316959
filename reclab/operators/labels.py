"""Ground-truth labels per user, in long form ``(user, item, count)``.

Relevance is binary set membership, so the label "list" is a set of rows;
nothing is collected per user (one user may hold a large share of rows).
``full`` is every held-out item.  ``top_tied`` keeps only the items tied at
the user's highest count: what an ordered window with its default
``RANGE .. CURRENT ROW`` frame followed by a dedup on the user actually kept
in practice, defined here deterministically to compare with such numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclab.operators.ordering import global_index

HOWS = ("full", "top_tied")


def labels(df: DataFrame, how: str = "full", user_col: str = "user", item_col: str = "item",
           count_col: str = "count") -> DataFrame:
    """Distinct ``(user, item, count)`` label rows.  The aggregation leaves the
    rows hash-partitioned on (user, item), which the metric join reuses."""
    base = (df.groupBy(user_col, item_col)
            .agg(F.sum(count_col).alias(count_col)))
    if how == "full":
        return base
    if how == "top_tied":
        top = base.groupBy(user_col).agg(F.max(count_col).alias("_top"))
        # on (user, count): a heavy user's rows are spread by their counts
        return base.join(top.withColumnRenamed("_top", count_col), [user_col, count_col], "left_semi").select(
            user_col, item_col, count_col)
    raise ValueError(f"how must be one of {HOWS}")


def ordered_labels(df: DataFrame, user_col: str = "user", item_col: str = "item",
                   count_col: str = "count") -> DataFrame:
    """``(user, item, count, label_pos)``: each user's items by count desc then
    item asc, position from 0.  Positions come from one distributed global
    order minus each user's first position.  First positions are joined on
    (user, range) with one row per pair that occurs, so a heavy user stays
    spread over the ranges it was sorted in."""
    base = labels(df, "full", user_col, item_col, count_col)
    ranked = global_index(base, [F.asc(user_col), F.desc(count_col), F.asc(item_col)],
                          idx_col="_g", range_col="_range")
    seen = ranked.groupBy(user_col, "_range").agg(F.min("_g").alias("_first"))
    first = seen.groupBy(user_col).agg(F.min("_first").alias("_g0"))
    starts = seen.select(user_col, "_range").join(first, user_col)
    return (ranked.join(starts, [user_col, "_range"])
            .select(user_col, item_col, count_col,
                    (F.col("_g") - F.col("_g0")).cast("int").alias("label_pos")))


def top_item_per_user(df: DataFrame, user_col: str = "user", item_col: str = "item",
                      count_col: str = "count") -> DataFrame:
    """One row per user, the item with the highest count, ties by the smallest
    item: a deterministic dedup on the user, computed as an aggregation (map-side
    partial, then final), not a window."""
    best = F.min(F.struct((-F.col(count_col)).alias("neg"), F.col(item_col).alias("it")))
    return (df.groupBy(user_col).agg(best.alias("_b"))
            .select(user_col, F.col("_b.it").alias(item_col),
                    (-F.col("_b.neg")).alias(count_col)))
