"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each reads the driver's tables (or what Spark derives from them) in full.
Computed columns carry the same names as in ``reclab.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reclab.functions.hashing import bucket
from reclab.operators import counts as cn
from reclab.operators import index as ix
from reclab.operators import labels as lb
from reclab.operators import metrics as mt
from reclab.operators import split as sp
from reclab.operators.popularity import popularity_topk, popularity_topk_by_group
from reclab.plans import data
from reclab.plans.registry import register
from reclab.sources import fixtures as fx

# Fixed parameters of the registered queries (the oracle SQL uses the same).
SAMPLE_FRACTION = 0.2
FIXED_N = {"train": 200, "val": 50, "test": 100}
POP_K = 50
METRIC_KS = (10, 50)
N_FOLDS = 5


query = register()


# ---- sources -------------------------------------------------------------

@query
def scan_interactions(spark, sf):
    return fx.interactions(spark, sf)


@query
def events_interactions(spark, sf):
    return fx.events_interactions(spark, sf)


@query
def sql_view_topk(spark, sf):
    """Top-10 report through a temp view and a SQL string."""
    fx.interactions(spark, sf).createOrReplaceTempView("reclab_interactions")
    return spark.sql("""
        SELECT track_id, COUNT(*) AS n_users, SUM(`count`) AS total
        FROM reclab_interactions GROUP BY track_id
        ORDER BY n_users DESC, track_id LIMIT 10""")


# ---- splits, sets, samples ------------------------------------------------

@query
def split_holdout(spark, sf):
    return data.split_table(spark, sf)


@query
def split_audit(spark, sf):
    return sp.audit(data.split_table(spark, sf))


@query
def describe_interactions(spark, sf):
    return sp.describe(data.split_table(spark, sf), "count", group_col="split")


@query
def union_splits(spark, sf):
    train, val, test = data.splits(spark, sf)
    # val listed in another column order: the union must go by name
    return sp.union_splits(train, val.select("user_id", "count", "track_id"), test)


@query
def project_triples(spark, sf):
    train, _, _ = data.splits(spark, sf)
    return train.select("user_id", "track_id", "count")


@query
def distinct_users(spark, sf):
    train, _, _ = data.splits(spark, sf)
    return sp.distinct_users(train)


@query
def users_train_only(spark, sf):
    return sp.users_only_in(*data.splits(spark, sf))


@query
def sample_users_exact(spark, sf):
    return sp.sample_users(sp.users_only_in(*data.splits(spark, sf)), fraction=SAMPLE_FRACTION)


@query
def sample_users_fixed(spark, sf):
    _, val, _ = data.splits(spark, sf)
    return sp.sample_users(sp.distinct_users(val), n=FIXED_N["val"], salt="val")


@query
def users_kept(spark, sf):
    train, val, test = data.splits(spark, sf)
    only = sp.users_only_in(train, val, test)
    return sp.union_users(sp.sample_users(only, fraction=SAMPLE_FRACTION), val, test)


@query
def filter_users_semi(spark, sf):
    train, val, _ = data.splits(spark, sf)
    return sp.filter_users(train, sp.distinct_users(val))


@query
def subsample_train(spark, sf):
    return sp.subsample(*data.splits(spark, sf), fraction=SAMPLE_FRACTION)


@query
def subsample_splits(spark, sf):
    train, val, test = data.splits(spark, sf)
    parts = sp.subsample_splits(train, val, test, FIXED_N["train"], FIXED_N["val"],
                                FIXED_N["test"], salt="fixed")
    return sp.union_splits(*parts)


@query
def cv_fold_sizes(spark, sf):
    train, _, _ = data.splits(spark, sf)
    return (train.withColumn("fold", bucket(N_FOLDS, "user_id", "track_id"))
            .groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.countDistinct("user_id").alias("n_users"),
                                 F.countDistinct("track_id").alias("n_items")))


# ---- counts ----------------------------------------------------------------

@query
def drop_low_counts(spark, sf):
    train, _, _ = data.splits(spark, sf)
    return cn.transform_counts(train, "drop")


@query
def count_log(spark, sf):
    train, _, _ = data.splits(spark, sf)
    out = cn.transform_counts(train, "log")
    return out.withColumn("count", F.round("count", 5))


@query
def count_transform_stats(spark, sf):
    train, _, _ = data.splits(spark, sf)
    return cn.transform_report(train)


# ---- indexing --------------------------------------------------------------

@query
def index_users(spark, sf):
    m = ix.fit_index(data.split_table(spark, sf), "user_id")
    return m.select(F.col("label").alias("user_id"), F.col("idx").alias("user"), "freq")


@query
def index_items(spark, sf):
    m = ix.fit_index(data.split_table(spark, sf), "track_id")
    return m.select(F.col("label").alias("track_id"), F.col("idx").alias("item"), "freq")


@query
def index_all_splits(spark, sf):
    _, _, frames = data.formatted(spark, sf)
    return sp.union_splits(*frames)


@query
def index_unseen_counts(spark, sf):
    """Fit on train only; count the held-out rows each policy would treat."""
    train, val, test = data.splits(spark, sf)
    users = ix.fit_index(train, "user_id")
    items = ix.fit_index(train, "track_id")
    both = sp.union_splits(train, val, test)
    kept = ix.apply_index(ix.apply_index(both, users, "user_id", "user", "keep"),
                          items, "track_id", "item", "keep")
    n_u = users.count()
    n_i = items.count()
    return kept.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum((F.col("user") == n_u).cast("long")).alias("n_unseen_user"),
        F.sum((F.col("item") == n_i).cast("long")).alias("n_unseen_item"),
        F.sum(((F.col("user") < n_u) & (F.col("item") < n_i)).cast("long")).alias("n_kept_skip"))


@query
def index_roundtrip(spark, sf):
    train, val, test = data.splits(spark, sf)
    both = sp.union_splits(train, val, test)
    users, items, _ = ix.index_splits(train, val, test)
    fmt = ix.apply_index(ix.apply_index(both, users, "user_id", "user"), items, "track_id", "item")
    back = ix.invert_index(ix.invert_index(fmt, users, "user", "user_back"),
                           items, "item", "track_back")
    same = (F.col("user_back") == F.col("user_id")) & (F.col("track_back") == F.col("track_id"))
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum(same.cast("long")).alias("n_equal"))


# ---- labels ----------------------------------------------------------------

def _val_labels(spark, sf, how="full"):
    _, val, _ = data.splits(spark, sf)
    return lb.labels(val, how, user_col="user_id", item_col="track_id")


@query
def labels_full(spark, sf):
    return _val_labels(spark, sf, "full")


@query
def labels_top_tied(spark, sf):
    return _val_labels(spark, sf, "top_tied")


@query
def ordered_label_list(spark, sf):
    _, val, _ = data.splits(spark, sf)
    return lb.ordered_labels(val, user_col="user_id", item_col="track_id")


@query
def dedup_user_top(spark, sf):
    _, val, _ = data.splits(spark, sf)
    return lb.top_item_per_user(val, user_col="user_id", item_col="track_id")


# ---- popularity and metrics ------------------------------------------------

def _pop(train, k=POP_K, by="users"):
    return popularity_topk(train, k, by=by, user_col="user_id", item_col="track_id")


@query
def popularity_top50(spark, sf):
    train, _, _ = data.splits(spark, sf)
    return _pop(train)


def _pop_metrics(spark, sf, how="full", cold="drop"):
    train, val, _ = data.splits(spark, sf)
    recs = _pop(train).select(F.col("track_id").alias("item"), "pos")
    lab = lb.labels(data.string_labels(val), how)
    return mt.ranking_metrics(recs, lab, ks=METRIC_KS, map_k=(10,), cold=cold)


@query
def metric_precision(spark, sf):
    return _pop_metrics(spark, sf).select("n_users_scored", "precision_at_10", "precision_at_50",
                                          "recall_at_10", "recall_at_50")


@query
def metric_map(spark, sf):
    return _pop_metrics(spark, sf).select("n_users_scored", "map", "map_at_10")


@query
def metric_ndcg(spark, sf):
    return _pop_metrics(spark, sf).select("n_users_scored", "ndcg_at_10", "ndcg_at_50")


@query
def metric_top_tied(spark, sf):
    """The same list scored against top-tied labels, to size the effect of
    truncated label lists on published numbers."""
    return _pop_metrics(spark, sf, "top_tied").select(
        "n_users_scored", "precision_at_10", "map", "ndcg_at_50")


@query
def metric_rmse(spark, sf):
    """RMSE of a fixed predictor (item mean of train counts) on val rows."""
    train, val, _ = data.splits(spark, sf)
    pred = train.groupBy("track_id").agg(F.avg("count").alias("prediction"))
    return mt.rmse(val.join(pred, "track_id"))


@query
def variant_compare(spark, sf):
    """Count strategies compared under one fixed model: popularity by summed
    transformed count, top 50, scored on the full val labels.  One scan of
    train produces every strategy's values; one grouped top-k and one grouped
    metric query score them all."""
    train, val, _ = data.splits(spark, sf)
    lab = lb.labels(data.string_labels(val), "full")
    long = cn.variants_long(train, cn.HOWS, cap=10.0)
    recs = popularity_topk_by_group(long, POP_K, "how", "v", item_col="track_id")
    m = mt.ranking_metrics(recs.select("how", F.col("track_id").alias("item"), "pos"), lab,
                           ks=(10, POP_K), cold="drop",
                           group_col="how", groups=list(cn.HOWS))
    return m.select("how", "n_users_scored", "precision_at_10", "map", "ndcg_at_50")


@query
def sweep_best(spark, sf):
    """The best count strategy of ``variant_compare`` by MAP (stable ties)."""
    return variant_compare(spark, sf).orderBy(F.desc("map"), "how").limit(1).select("how", "map")


@query
def describe_columns(spark, sf):
    """``describe()`` of every column, string ones included."""
    return sp.describe_columns(fx.interactions(spark, sf))


@query
def head_interactions(spark, sf):
    """``show()``'s first rows, made deterministic by a key order."""
    return fx.interactions(spark, sf).orderBy("user_id", "track_id").limit(20)


# ---- the tie-heavy events fixture (traps T1, T5) -----------------------------

@query
def events_transform_stats(spark, sf):
    """Count strategies on mostly-1 counts: ``log`` zeroes most rows."""
    return cn.transform_report(fx.events_interactions(spark, sf))


@query
def events_labels_top_tied(spark, sf):
    """Items tied at each user's top count (many ties at small counts)."""
    return lb.labels(fx.events_interactions(spark, sf), "top_tied", user_col="user_id",
                     item_col="track_id")
