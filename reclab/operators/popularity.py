"""Popularity baseline: a fixed predictor, so metric results are exactly
reproducible by SQL (unlike factor models)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def popularity_topk(train: DataFrame, k: int, by: str = "users", user_col: str = "user",
                    item_col: str = "item", count_col: str = "count") -> DataFrame:
    """Global top-``k`` ``(pos, item, score)``: items by number of users
    (``by="users"``) or by summed count (``by="count"``), ties by item.

    The aggregation is partial+final; the top-k is a ``TakeOrderedAndProject``
    (each task keeps k rows); positions are numbered on the k survivors."""
    score = F.count(F.lit(1)) if by == "users" else F.sum(F.col(count_col).cast("double"))
    top = (train.groupBy(item_col).agg(score.alias("score"))
           .orderBy(F.desc("score"), F.asc(item_col)).limit(k))
    w = Window.orderBy(F.desc("score"), F.asc(item_col))
    return top.select((F.row_number().over(w) - 1).cast("int").alias("pos"), item_col, "score")



def popularity_topk_by_group(df: DataFrame, k: int, group_col: str, value_col: str,
                             item_col: str = "item") -> DataFrame:
    """Top-``k`` ``(group, pos, item, score)`` per group by summed value, ties
    by item.  The ``row_number() <= k`` filter becomes a window group limit
    that Spark applies before the shuffle as well as after it."""
    agg = df.groupBy(group_col, item_col).agg(F.sum(F.col(value_col).cast("double")).alias("score"))
    w = Window.partitionBy(group_col).orderBy(F.desc("score"), F.asc(item_col))
    return (agg.withColumn("pos", (F.row_number().over(w) - 1).cast("int"))
            .where(F.col("pos") < k).select(group_col, "pos", item_col, "score"))
