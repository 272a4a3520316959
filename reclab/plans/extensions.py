"""README extensions as registered queries: fast search (exact and two
approximate methods), cold start from item features, error analysis by item
group, and a low-dimensional factor layout."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F

from reclab.functions.vectors import scale
from reclab.operators import als as A
from reclab.operators import analysis as an
from reclab.operators import coldstart as cs
from reclab.operators import labels as lb
from reclab.operators import metrics as mt
from reclab.operators import search as S
from reclab.operators.popularity import popularity_topk
from reclab.plans import data
from reclab.plans.contracts import ITERS, RANK, K, _fitted
from reclab.plans.oracle import SPLIT, h, with_
from reclab.plans.registry import register
from reclab.session import materialise
from reclab.sources import fixtures as fx

TOP = 10
PROBES = 2


def _unit(spark, sf):
    return S.vectors(fx.load_table(spark, sf, "embeddings"), "vec_id", "embedding")


def _scaled(spark, sf):
    """Non-unit item vectors: each embedding times (1 + vec_id % 5)."""
    emb = fx.load_table(spark, sf, "embeddings")
    return emb.select(F.col("vec_id").cast("long").alias("id"),
                      scale("embedding", (1 + F.col("vec_id") % 5).cast("double")).alias("v"))


def _exact(spark, sf, items, digits=5):
    q = _unit(spark, sf)
    part = S.fit_partitions(items)
    res = S.mips_exact(q, part, TOP, PROBES, exclude_self=True, digits=digits)
    return res.select(F.col("qid").alias("query_id"), F.col("id").alias("item_id"),
                      F.col("rank").cast("int").alias("rank"), F.round("score", digits).alias("score"))


def _mips_sql(scaled: bool, digits: int = 5) -> str:
    factor = "(1 + i.vec_id % 5) * " if scaled else ""
    return f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sc AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id,
              round({factor}list_dot_product(q.e, i.e), {digits}) AS score
       FROM v q JOIN v i ON q.vec_id <> i.vec_id)
SELECT query_id, item_id, CAST(rank AS INTEGER) AS rank, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM sc)
WHERE rank <= {TOP}"""


@register(_mips_sql(scaled=True))
def mips_bruteforce(spark, sf):
    """Exact top-10 by inner product for every embedding against all other
    (scaled) embeddings; checked against brute force SQL."""
    return _exact(spark, sf, _scaled(spark, sf))


@register(_mips_sql(scaled=False))
def mips_exact_unit(spark, sf):
    return _exact(spark, sf, _unit(spark, sf))


@register(_mips_sql(scaled=True, digits=1))
def mips_rounded_ties(spark, sf):
    """Exact search where rounding makes most scores tie: order by the rounded
    score, then by id, across clusters."""
    return _exact(spark, sf, _scaled(spark, sf), digits=1)


def _recall(exact, approx):
    return float(S.recall_at_k(exact, approx).first()["recall"])


def _true_scores(top, items, queries):
    """Rows of ``top`` and how many of their scores are the inner products."""
    both = (top.join(items.select("id", "v"), "id")
            .join(queries.select(F.col("id").alias("qid"), F.col("v").alias("q")), "qid")
            .withColumn("dot", F.aggregate(F.zip_with("v", "q", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)))
    ok = F.abs(F.col("dot") - F.col("score")) < 1e-6
    return both.agg(F.count(F.lit(1)).alias("n"), F.sum(ok.cast("long")).alias("ok")).first()


_SEARCH: dict = {}


def _search_inputs(spark, sf):
    """Queries, items, their clustering and the exact top-k: once per session
    and data (shared by the recall queries)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SEARCH:
        q, items = _unit(spark, sf), _scaled(spark, sf)
        part = S.fit_partitions(items)
        exact = S.mips_exact(q, part, TOP, PROBES, exclude_self=True).cache()
        _SEARCH[key] = (q, items, part, exact)
    return _SEARCH[key]


@register("""SELECT CAST(count(*) AS BIGINT) AS n_queries, 1.0::DOUBLE AS recall_all_probes,
  1.0::DOUBLE AS share_all_probes, true AS recall_does_not_fall, true AS share_grows,
  CAST(count(*) * least(10, (SELECT count(*) FROM embeddings) - 1) AS BIGINT) AS n_true_scores FROM embeddings""")
def partition_search_recall(spark, sf):
    """Partition search against the exact result: visiting every cluster finds
    everything at share 1; fewer clusters never find more; every score it
    returns is an inner product."""
    q, items, part, exact = _search_inputs(spark, sf)
    n = len(part.centres)
    probes = sorted({1, max(1, n // 4), n})
    tops = [S.mips_partition(q, part, TOP, p, exclude_self=True).cache() for p in probes]
    recalls = [_recall(exact, t) for t in tops]
    shares = [S.candidate_share(q, part, p, True) for p in probes]
    true = _true_scores(tops[-1], items, q)
    for t in tops:
        t.unpersist()
    return spark.createDataFrame(
        [(q.count(), recalls[-1], shares[-1], recalls == sorted(recalls), shares == sorted(shares), true["ok"])],
        "n_queries long, recall_all_probes double, share_all_probes double, recall_does_not_fall boolean, "
        "share_grows boolean, n_true_scores long")


@register("""SELECT CAST(count(*) AS BIGINT) AS n_queries, true AS all_scores_true, true AS share_at_most_one,
  true AS recall_does_not_fall, true AS share_grows FROM embeddings""")
def lsh_recall(spark, sf):
    """LSH against the exact result: more tables never find less; their
    candidate pairs count once however many tables meet them; every score is
    an inner product."""
    q, items, _, exact = _search_inputs(spark, sf)
    n = q.count()

    def run(length, tables):
        top, pairs = S.mips_lsh(q, items, TOP, bucket_length=length, num_tables=tables, exclude_self=True)
        top = top.cache()
        true = _true_scores(top, items, q)
        out = _recall(exact, top), pairs / float(n * (n - 1)), true["n"] == true["ok"]
        top.unpersist()
        return out

    wide, few, more = run(1e6, 3), run(0.4, 1), run(0.4, 3)
    return spark.createDataFrame(
        [(n, wide[2] and few[2] and more[2], max(wide[1], few[1], more[1]) <= 1.0, few[0] <= more[0] <= 1.0,
          few[1] <= more[1])],
        "n_queries long, all_scores_true boolean, share_at_most_one boolean, recall_does_not_fall boolean, "
        "share_grows boolean")


@register()
def search_report(spark, sf):
    """Recall@10, share of pairs examined and seconds per method (values
    depend on clustering and hashing seeds: rows-only check)."""
    q, items = _unit(spark, sf), _scaled(spark, sf)
    n = q.count()
    t0 = time.time()
    part = S.fit_partitions(items)
    exact = S.mips_exact(q, part, TOP, PROBES, exclude_self=True).cache()
    exact.count()
    took = time.time() - t0
    rows = [("exact", "probe=2+bound", 1.0, S.exact_share(q, part, TOP, PROBES, True), took)]
    for p in (2, 5):
        t0 = time.time()
        ap = S.mips_partition(q, part, TOP, p, exclude_self=True)
        rec = S.recall_at_k(exact, ap).first()["recall"]
        rows.append(("partition", f"probe={p}", float(rec), S.candidate_share(q, part, p, True),
                     time.time() - t0))
    for bl, nt in ((0.4, 1), (0.05, 2)):
        t0 = time.time()
        ap, n_pairs = S.mips_lsh(q, items, TOP, bucket_length=bl, num_tables=nt, exclude_self=True)
        rec = S.recall_at_k(exact, ap).first()["recall"]
        rows.append(("lsh", f"bucket={bl},tables={nt}", float(rec), n_pairs / float(n * (n - 1)),
                     time.time() - t0))
    return spark.createDataFrame(rows, "method string, setting string, recall double, "
                                       "candidate_share double, seconds double")


# ---- cold start -------------------------------------------------------------

@register(with_(SPLIT) + f"""
SELECT split, ({h("'item:' || track_id")} % 10) = 0 AS cold, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT track_id) AS BIGINT) AS n_items
FROM split GROUP BY 1, 2""")
def cold_item_split(spark, sf):
    df = cs.cold_items(data.split_table(spark, sf))
    return df.groupBy("split", "cold").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.countDistinct("track_id").alias("n_items"))


def _side_by_idx(spark, sf, items_map):
    side = fx.item_side(spark, sf)
    return side.join(items_map.select(F.col("label").alias("track_id"), F.col("idx").alias("id")),
                     "track_id")


_COLD: dict = {}


def _cold_setup(spark, sf, rank, iters):
    """Warm model and predicted factors, computed once per session, data and
    model size (shared by the contract and the report)."""
    key = (spark.sparkContext.applicationId, sf, rank, iters)
    if key not in _COLD:
        _COLD[key] = _cold_fit(spark, sf, rank, iters)
    return _COLD[key]


def _cold_fit(spark, sf, rank, iters):
    users, items, (train, val, _) = data.formatted(spark, sf)
    cold = (cs.cold_items(items.select("label", "idx"), item_col="label")
            .where("cold").select(F.col("idx").alias("item")))
    train, val = materialise(train, "train"), materialise(val, "val")
    warm_train = train.join(cold, "item", "left_anti")
    model_warm = A.fit_als(warm_train, rank=rank, max_iter=iters, seed=0)
    side = _side_by_idx(spark, sf, items)
    fmap = cs.fit_feature_map(model_warm.itemFactors, side, rank)
    pred = cs.predict_factors(fmap, side.join(cold.withColumnRenamed("item", "id"), "id", "left_semi"))
    return train, val, materialise(cold, "cold"), model_warm, materialise(pred, "predicted")


@register(with_(SPLIT) + f""",
cold AS (SELECT DISTINCT track_id FROM split WHERE ({h("'item:' || track_id")} % 10) = 0)
SELECT CAST((SELECT count(*) FROM cold) AS BIGINT) AS n_cold_items,
       CAST((SELECT count(*) FROM cold) AS BIGINT) AS n_predicted,
       CAST({RANK} AS INTEGER) AS len_min, CAST({RANK} AS INTEGER) AS len_max, true AS normal_equations_hold""")
def cold_start_contract(spark, sf):
    """Every held-out item gets factors, and the fitted map solves its normal
    equations: without a penalty, residuals are orthogonal to the features."""
    _, _, cold, model, pred = _cold_setup(spark, sf, RANK, ITERS)
    _, items, _ = data.formatted(spark, sf)
    design = cs.feature_pipeline().fit(side := _side_by_idx(spark, sf, items)).transform(
        model.itemFactors.join(side, "id"))
    xx, xy, n = cs.normal_equations(design, RANK)
    left = np.abs(xx @ cs.solve_ridge(xx, xy, n, 0.0) - xy).max()
    return (cold.agg(F.count(F.lit(1)).alias("n_cold_items")).withColumn("_k", F.lit(1))
            .join(pred.agg(F.count(F.lit(1)).alias("n_predicted"),
                           F.min(F.size("features")).alias("len_min"),
                           F.max(F.size("features")).alias("len_max")).withColumn("_k", F.lit(1)), "_k")
            .drop("_k").withColumn("normal_equations_hold", F.lit(bool(left <= 1e-6 * np.abs(xy).max()))))


@register()
def cold_start_report(spark, sf):
    """Full model vs warm model + feature-predicted factors for held-out
    items, scored on all val labels and on val labels of held-out items."""
    rank, iters, k = RANK, ITERS, K   # same model size as cold_start_contract: shared setup
    train, val, cold, model_warm, pred = _cold_setup(spark, sf, rank, iters)
    model_full = A.fit_als(train, rank=rank, max_iter=iters, seed=0)
    full_recs = A.to_long(A.recommend_users(model_full, k, val)).select("user", "pos", "item")
    item_vecs = (model_warm.itemFactors.join(cold.withColumnRenamed("item", "id"), "id", "left_anti")
                 .unionByName(pred))
    users = (model_warm.userFactors.join(val.select(F.col("user").alias("id")).distinct(), "id",
                                         "left_semi"))
    part = S.fit_partitions(S.vectors(item_vecs, "id", "features"))
    top = S.mips_exact(S.vectors(users, "id", "features"), part, k, probes=4)
    cold_recs = top.select(F.col("qid").cast("int").alias("user"),
                           (F.col("rank") - 1).cast("int").alias("pos"),
                           F.col("id").cast("int").alias("item"))
    # each list is joined to the labels once, as it is made; what is left of it
    # feeds both scopes
    lab_all = lb.labels(val, "full").cache()
    lab_cold = lab_all.join(cold, "item", "left_semi")
    full_recs, cold_recs = (materialise(mt.leads_and_hits(recs, lab_all), "hits") for recs in (full_recs, cold_recs))
    out = None
    for name, recs in (("full_model", full_recs), ("warm_plus_features", cold_recs)):
        for scope, lab in (("all_items", lab_all), ("held_out_items", lab_cold)):
            m = mt.ranking_metrics(recs, lab, ks=(10, k)).select(
                F.lit(name).alias("model"), F.lit(scope).alias("labels"), "n_users_scored",
                "precision_at_10", "map", F.col(f"ndcg_at_{k}").alias("ndcg_at_k"))
            out = m if out is None else out.unionByName(m)
    return out


# ---- error analysis and layout ------------------------------------------------

POP50 = """pop AS (
  SELECT track_id FROM (
    SELECT track_id, row_number() OVER (ORDER BY score DESC, track_id) - 1 AS pos
    FROM (SELECT track_id, count(*) AS score FROM train GROUP BY track_id)) WHERE pos < 50)"""
LAB = """lab AS (SELECT DISTINCT user_id, track_id FROM val)"""


def _error_sql(side: str, col: str) -> str:
    return with_(SPLIT, POP50, LAB, f"side AS ({side})", f"""c AS (
  SELECT g AS {col}, CASE WHEN grouping(g) = 1 THEN 'total' WHEN g IS NULL THEN 'unknown' ELSE 'group' END AS kind,
         sum(r) AS n_rec_slots, sum(l) AS n_label_rows, sum(hh) AS n_hits
  FROM (
    SELECT s.g, 1 AS r, 0 AS l, 0 AS hh FROM pop p LEFT JOIN side s USING (track_id)
    UNION ALL
    SELECT s.g, 0, 1, CASE WHEN l.track_id IN (SELECT track_id FROM pop) THEN 1 ELSE 0 END
    FROM lab l LEFT JOIN side s USING (track_id))
  GROUP BY ROLLUP (g))""", """t AS (SELECT n_rec_slots AS tr, n_label_rows AS tl FROM c WHERE kind = 'total')""") + f"""
SELECT {col}, kind, CAST(n_rec_slots AS BIGINT) AS n_rec_slots, CAST(n_label_rows AS BIGINT) AS n_label_rows,
  CAST(n_hits AS BIGINT) AS n_hits, round(n_rec_slots / tr, 5) AS rec_share,
  round(n_label_rows / tl, 5) AS label_share,
  round(CASE WHEN n_label_rows > 0 THEN (n_rec_slots / tr) / (n_label_rows / tl) END, 5) AS share_ratio,
  round(CASE WHEN n_label_rows > 0 THEN n_hits / n_label_rows END, 5) AS hit_rate
FROM c, t"""


TRACK = "'T' || CAST(p_partkey AS VARCHAR) AS track_id"


def _popular_errors(spark, sf, side, col):
    train, val, _ = data.splits(spark, sf)
    recs = popularity_topk(train, 50, user_col="user_id", item_col="track_id")
    return an.error_by_group(recs, lb.labels(val, "full", "user_id", "track_id"), side, col,
                             item_col="track_id", user_col="user_id")


@register(_error_sql(f"SELECT {TRACK}, p_type AS g FROM part", "p_type"))
def error_by_group(spark, sf):
    """Which item types the top-50 popularity list over/under-represents
    against the val labels."""
    return _popular_errors(spark, sf, fx.item_side(spark, sf), "p_type")


@register(_error_sql(f"SELECT {TRACK}, unnest(string_split(p_name, ' ')) AS g FROM part", "tag"))
def error_by_tag(spark, sf):
    """The same by tag: the words of an item's name."""
    side = fx.item_side(spark, sf).select("track_id", F.explode(F.split("p_name", " ")).alias("tag"))
    return _popular_errors(spark, sf, side, "tag")


@register(with_(SPLIT, f"side AS (SELECT {TRACK}, p_type AS g FROM part)",
                "warm AS (SELECT count(DISTINCT user_id) AS n FROM val WHERE user_id IN (SELECT user_id FROM train))",
                "items AS (SELECT count(DISTINCT track_id) AS n FROM train)") + f"""
SELECT g AS p_type, CASE WHEN grouping(g) = 1 THEN 'total' WHEN g IS NULL THEN 'unknown' ELSE 'group' END AS kind,
  CAST(count(*) AS BIGINT) AS n_label_rows,
  CAST(CASE WHEN grouping(g) = 1 THEN (SELECT n FROM warm) * least({K}, (SELECT n FROM items)) ELSE 0 END AS BIGINT) AS total_slots,
  true AS hits_bounded
FROM (SELECT DISTINCT user_id, track_id FROM val) l LEFT JOIN side s USING (track_id) GROUP BY ROLLUP (g)""")
def error_by_group_als(spark, sf):
    """Error analysis of the model's own lists: label rows and the total of
    slots are exact; hits stay within slots and label rows."""
    _, val, model = _fitted(spark, sf)
    _, items, _ = data.formatted(spark, sf)
    side = _side_by_idx(spark, sf, items).select(F.col("id").alias("item"), "p_type")
    recs = A.to_long(A.recommend_users(model, K, val)).select("user", "pos", "item")
    out = an.error_by_group(recs, lb.labels(val, "full"), side, "p_type")
    return out.select("p_type", "kind", "n_label_rows",
                      F.when(F.col("kind") == "total", F.col("n_rec_slots")).otherwise(0).alias("total_slots"),
                      ((F.col("n_hits") <= F.col("n_label_rows")) & (F.col("n_hits") <= F.col("n_rec_slots")))
                      .alias("hits_bounded")).where("n_label_rows > 0")


def _layout(spark, sf):
    train, _, model = _fitted(spark, sf)
    _, items, _ = data.formatted(spark, sf)
    side = _side_by_idx(spark, sf, items).select("id", "p_type", "p_brand")
    return an.factor_layout(model.itemFactors, side, dims=2, group_col="p_type")


def _centroid_check(layout, cents, group):
    """Group sizes, and whether the centroids, weighted by size, average to
    the mean of all points, with the first axis spread at least as wide as the
    second."""
    mean = layout.agg(F.avg("x0").alias("m0"), F.avg("x1").alias("m1"),
                      (F.var_pop("x0") >= F.var_pop("x1")).alias("ordered")).withColumn("_k", F.lit(1))
    both = cents.agg((F.sum(F.col("n_items") * F.col("c0")) / F.sum("n_items")).alias("g0"),
                     (F.sum(F.col("n_items") * F.col("c1")) / F.sum("n_items")).alias("g1")).withColumn("_k", F.lit(1))
    ok = mean.join(both, "_k").select("_k", ((F.abs(F.col("m0") - F.col("g0")) < 1e-6)
                                             & (F.abs(F.col("m1") - F.col("g1")) < 1e-6)).alias("centroids_average"),
                                      F.col("ordered").alias("axes_ordered"))
    return cents.withColumn("_k", F.lit(1)).join(F.broadcast(ok), "_k").select(
        group, "n_items", "centroids_average", "axes_ordered")


@register(with_(SPLIT) + """
SELECT p.p_type, CAST(count(DISTINCT t.track_id) AS BIGINT) AS n_items, true AS centroids_average, true AS axes_ordered
FROM train t JOIN part p ON t.track_id = 'T' || CAST(p.p_partkey AS VARCHAR) GROUP BY p.p_type""")
def factor_pca(spark, sf):
    return _centroid_check(*_layout(spark, sf), "p_type")


@register(with_(SPLIT) + """
SELECT c.c_mktsegment, CAST(count(DISTINCT t.user_id) AS BIGINT) AS n_items, true AS centroids_average,
  true AS axes_ordered
FROM train t JOIN customer c ON t.user_id = 'U' || CAST(c.c_custkey AS VARCHAR) GROUP BY c.c_mktsegment""")
def user_layout(spark, sf):
    """The users' factors on two axes, grouped by market segment."""
    _, _, model = _fitted(spark, sf)
    users, _, _ = data.formatted(spark, sf)
    side = fx.user_side(spark, sf).join(
        users.select(F.col("label").alias("user_id"), F.col("idx").alias("id")), "user_id")
    return _centroid_check(*an.factor_layout(model.userFactors, side.select("id", "c_mktsegment"), dims=2,
                                             group_col="c_mktsegment"), "c_mktsegment")


@register()
def factor_layout(spark, sf):
    layout, _ = _layout(spark, sf)
    return layout
