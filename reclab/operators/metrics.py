"""Ranking metrics as one DataFrame query (no RDD, no Python rows).

Recommendations come in long form ``(user, pos, item)`` with ``pos`` from 0,
or as one global list ``(pos, item)`` shared by every user.  With ``m`` the
number of labels of a user and ``hit_i`` whether prediction ``i`` is a label:

* precision@k = sum_{i<k} hit_i / k (divided by k even for shorter lists)
* recall@k    = sum_{i<k} hit_i / m
* AP          = sum_i hit_i * (hits up to i) / (i + 1) / m
* AP@k        = same over i < k, divided by min(m, k)
* nDCG@k      = sum_{i<k} hit_i / log2(i + 2) / sum_{i<min(m,k)} 1 / log2(i + 2)

These equal Spark's ``RankingMetrics``.  Only hit positions are gathered per
user, so a user contributes at most K values however long the label set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum_array(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def _idcg(m: Column, k: int) -> Column:
    n = F.least(m, F.lit(k))
    gains = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                        lambda i: F.lit(1.0) / F.log2(i + 2))
    return F.when(n > 0, _sum_array(gains)).otherwise(F.lit(0.0))


def per_user_metrics(recs: DataFrame, labels: DataFrame, ks=(10,), map_k=(),
                     cold: str = "drop", user_col: str = "user", item_col: str = "item",
                     pos_col: str = "pos", include_unlabeled: bool = False,
                     group_col: str | None = None, groups: list | None = None,
                     scored_users: DataFrame | None = None) -> DataFrame:
    """One row per evaluated user (per group): ``scored`` flag and every metric.
    Labels are a set: repeated (user, item) rows count once.

    Users come from ``labels``; ``cold="zero"`` keeps label users without
    recommendations (scoring 0), ``include_unlabeled`` adds users with
    recommendations but no labels (scoring 0, as ``RankingMetrics`` does for an
    empty label set).  ``scored_users`` names the users that were scored where
    the caller knows them (saves reading ``recs`` a second time).
    ``group_col`` scores several lists at once (for example one per count
    strategy): every user is evaluated under every group; ``groups`` names
    the group values when the caller knows them (saves a pass over ``recs``)."""
    if cold not in ("drop", "zero"):
        raise ValueError("cold must be drop or zero")
    ks, map_k = sorted(set(ks)), sorted(set(map_k))
    keys = [group_col, user_col] if group_col else [user_col]
    lab = labels.select(user_col, item_col).distinct()
    m = lab.groupBy(user_col).agg(F.count(F.lit(1)).alias("m"))
    gcols = [group_col] if group_col else []
    if user_col in recs.columns:
        hits = recs.select(*gcols, user_col, item_col, pos_col).join(lab, [user_col, item_col])
        scored = (scored_users if scored_users is not None else recs).select(*keys).distinct().withColumn(
            "scored", F.lit(True))
    else:
        hits = lab.join(recs.select(*gcols, item_col, pos_col), item_col)  # AQE broadcasts a list it measures small
        scored = None
    hp = (hits.groupBy(*keys)
          .agg(F.array_sort(F.collect_list(F.col(pos_col).cast("int"))).alias("hp")))
    if group_col:
        # every label user is evaluated under every group; the group values
        # are few (one per compared list), so they travel as a literal array
        if groups is None:
            groups = [r[0] for r in recs.select(group_col).distinct().collect()]
        m = m.withColumn(group_col, F.explode(F.array(*[F.lit(g) for g in groups])))
    users = m.join(hp, keys, "left")
    if scored is not None:
        users = users.join(scored, keys, "full" if include_unlabeled else "left")
        users = (users.withColumn("scored", F.coalesce("scored", F.lit(False)))
                 .withColumn("m", F.coalesce("m", F.lit(0).cast("long"))))
    else:
        users = users.withColumn("scored", F.lit(True))
    if cold == "drop":
        users = users.where("scored")
    hpc = F.coalesce(F.col("hp"), F.array().cast("array<int>"))
    mc = F.col("m").cast("double")
    cols = [F.col(c) for c in keys] + [F.col("scored"), F.col("m")]
    for k in ks:
        n_hit = F.size(F.filter(hpc, lambda p: p < k)).cast("double")
        dcg = _sum_array(F.transform(F.filter(hpc, lambda p: p < k),
                                     lambda p: F.lit(1.0) / F.log2(p + 2)))
        cols += [(n_hit / k).alias(f"precision_at_{k}"),
                 F.when(F.col("m") > 0, n_hit / mc).otherwise(0.0).alias(f"recall_at_{k}"),
                 F.when(F.col("m") > 0, dcg / _idcg(F.col("m"), k)).otherwise(0.0)
                 .alias(f"ndcg_at_{k}")]
    ap_terms = F.transform(hpc, lambda p, j: (j + 1).cast("double") / (p + 1))
    cols.append(F.when(F.col("m") > 0, _sum_array(ap_terms) / mc).otherwise(0.0).alias("ap"))
    for k in map_k:
        terms = F.transform(F.filter(hpc, lambda p: p < k), lambda p, j: (j + 1).cast("double") / (p + 1))
        cols.append(F.when(F.col("m") > 0, _sum_array(terms) / F.least(mc, F.lit(float(k))))
                    .otherwise(0.0).alias(f"ap_at_{k}"))
    return users.select(*cols)


def leads_and_hits(recs: DataFrame, labels: DataFrame, user_col: str = "user", item_col: str = "item",
                   pos_col: str = "pos") -> DataFrame:
    """The rows of ``recs`` that a metric depends on: hits, and the first of
    each list, which tells that its user was scored.  Metrics of these rows are
    those of ``recs`` under ``labels`` and under any part of them, so long lists
    that are scored several times need to be shuffled once only."""
    lab = labels.select(user_col, item_col).distinct().withColumn("_hit", F.lit(True))
    return (recs.select(user_col, item_col, pos_col).join(lab, [user_col, item_col], "left")
            .where(F.col("_hit") | (F.col(pos_col) == 0)).drop("_hit"))


def ranking_metrics(recs: DataFrame, labels: DataFrame, ks=(10,), map_k=(), cold: str = "drop",
                    digits: int | None = 5, user_col: str = "user", item_col: str = "item",
                    pos_col: str = "pos", include_unlabeled: bool = False,
                    group_col: str | None = None, groups: list | None = None,
                    scored_users: DataFrame | None = None) -> DataFrame:
    """One row (per group): users scored, users with labels but no
    recommendations (both always counted), and the mean of each metric, over
    scored users only with ``cold="drop"`` (rounded last, to ``digits``
    places)."""
    if cold not in ("drop", "zero"):
        raise ValueError("cold must be drop or zero")
    pu = per_user_metrics(recs, labels, ks, map_k, "zero", user_col, item_col, pos_col,
                          include_unlabeled, group_col, groups, scored_users)
    metric_cols = [c for c in pu.columns if c not in (user_col, group_col, "scored", "m")]

    def r(c):
        return F.round(c, digits) if digits is not None else c

    def name(c):
        return "map" if c == "ap" else ("map_at_" + c[6:] if c.startswith("ap_at_") else c)

    aggs = [F.sum(F.col("scored").cast("long")).alias("n_users_scored"),
            F.sum((~F.col("scored")).cast("long")).alias("n_users_cold")]
    counted = F.col("scored") | F.lit(cold == "zero")
    aggs += [r(F.avg(F.when(counted, F.col(c)))).alias(name(c)) for c in metric_cols]
    return pu.groupBy(group_col).agg(*aggs) if group_col else pu.agg(*aggs)


def rmse(df: DataFrame, label_col: str = "count", prediction_col: str = "prediction",
         digits: int | None = 5) -> DataFrame:
    """Root mean squared error over rows with a prediction (one aggregation)."""
    d = F.col(label_col).cast("double") - F.col(prediction_col).cast("double")
    val = F.sqrt(F.avg(d * d))
    return df.where(F.col(prediction_col).isNotNull() & ~F.isnan(prediction_col)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.round(val, digits) if digits is not None else val).alias("rmse"))
