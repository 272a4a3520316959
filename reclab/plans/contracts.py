"""Factor-model queries.  ALS factors are not reproducible by SQL, so these
return property tables: counts, list lengths, position ranges and flags whose
expected values SQL can derive from the same tables (no factor or score value
is ever hashed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclab.operators import als as A
from reclab.operators import labels as lb
from reclab.operators import sweep as sw
from reclab.plans import data
from reclab.plans.evaluate import FLAGSHIP
from reclab.plans.oracle import SPLIT, h, with_
from reclab.plans.registry import register
from reclab.session import materialise, scratch_path
from reclab.sources import io

# the flagship's model: rank 10, 10 iterations, lists of 500
RANK, ITERS, K = FLAGSHIP["rank"], FLAGSHIP["max_iter"], FLAGSHIP["k"]

_FITTED: dict = {}


def _fitted(spark, sf, implicit=True):
    """Formatted splits and one fitted model per (session, data, kind)."""
    key = (spark.sparkContext.applicationId, sf, implicit)
    if key not in _FITTED:
        _, _, (train, val, _) = data.formatted(spark, sf)
        train, val = materialise(train, "train"), materialise(val, "val")
        model = A.fit_als(train, rank=RANK, max_iter=ITERS, implicit=implicit, seed=0)
        _FITTED[key] = (train, val, model)
    return _FITTED[key]


def _row(*frames: DataFrame) -> DataFrame:
    """Put one-row aggregates side by side (equi-join on a constant key)."""
    out = frames[0].withColumn("_k", F.lit(1))
    for f in frames[1:]:
        out = out.join(f.withColumn("_k", F.lit(1)), "_k")
    return out.drop("_k")


N_TRAIN_USERS = "(SELECT count(DISTINCT user_id) FROM train)"
N_TRAIN_ITEMS = "(SELECT count(DISTINCT track_id) FROM train)"
VAL_WARM = "(SELECT * FROM val WHERE user_id IN (SELECT user_id FROM train))"
N_VAL_WARM_USERS = f"(SELECT count(DISTINCT user_id) FROM {VAL_WARM})"
N_VAL_WARM_PAIRS = """(SELECT count(*) FROM val WHERE user_id IN (SELECT user_id FROM train)
  AND track_id IN (SELECT track_id FROM train))"""


def _factor_contract(model) -> DataFrame:
    def side(df, name):
        return df.agg(F.count(F.lit(1)).alias(f"n_{name}_factors"),
                      F.min(F.size("features")).alias(f"{name}_len_min"),
                      F.max(F.size("features")).alias(f"{name}_len_max"))
    return _row(side(model.userFactors, "user"), side(model.itemFactors, "item"))


FACTOR_SQL = with_(SPLIT) + f"""
SELECT CAST({N_TRAIN_USERS} AS BIGINT) AS n_user_factors, CAST({RANK} AS INTEGER) AS user_len_min,
       CAST({RANK} AS INTEGER) AS user_len_max, CAST({N_TRAIN_ITEMS} AS BIGINT) AS n_item_factors,
       CAST({RANK} AS INTEGER) AS item_len_min, CAST({RANK} AS INTEGER) AS item_len_max"""


@register(FACTOR_SQL)
def als_factor_contract(spark, sf):
    return _factor_contract(_fitted(spark, sf)[2])


@register(FACTOR_SQL.replace("AS item_len_max", "AS item_len_max, true AS fits_counts_better"))
def als_explicit_contract(spark, sf):
    """Explicit ALS fits the counts themselves: on its training pairs its
    RMSE against the counts is below the implicit model's."""
    from reclab.plans.evaluate import rating_errors

    train, _, implicit = _fitted(spark, sf)
    explicit = _fitted(spark, sf, implicit=False)[2]
    errors = [rating_errors(m, train).select(F.col("rmse_counts").alias(n))
              for m, n in ((explicit, "explicit"), (implicit, "implicit"))]
    better = _row(*errors).select((F.col("explicit") < F.col("implicit")).alias("fits_counts_better"))
    return _row(_factor_contract(explicit), better)


@register(with_(SPLIT) + f"""
SELECT CAST({N_VAL_WARM_PAIRS} AS BIGINT) AS n_rows, CAST({N_VAL_WARM_PAIRS} AS BIGINT) AS n_match""")
def als_score_contract(spark, sf):
    """Scores equal the inner product of the two factor vectors."""
    _, val, model = _fitted(spark, sf)
    pred = A.score(model, val, "drop")
    both = A.factor_dot(model, pred)
    ok = F.abs(F.col("prediction") - F.col("dot")) <= 1e-4 * F.greatest(F.lit(1.0), F.abs("dot"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(ok.cast("long")).alias("n_match"))


def _list_props(recs: DataFrame, key: str, value: str) -> DataFrame:
    arr = F.col("recommendations")
    ratings = F.col(f"recommendations.rating")
    return recs.agg(
        F.count(F.lit(1)).alias(f"n_{key}s"),
        F.min(F.size(arr)).alias("len_min"), F.max(F.size(arr)).alias("len_max"),
        F.sum((F.size(F.array_distinct(F.col(f"recommendations.{value}"))) == F.size(arr))
              .cast("long")).alias("n_no_repeat"),
        F.sum((ratings == F.reverse(F.array_sort(ratings))).cast("long")).alias("n_sorted"))


@register(with_(SPLIT) + f"""
SELECT CAST({N_VAL_WARM_USERS} AS BIGINT) AS n_users,
       CAST(least({K}, {N_TRAIN_ITEMS}) AS INTEGER) AS len_min,
       CAST(least({K}, {N_TRAIN_ITEMS}) AS INTEGER) AS len_max,
       CAST({N_VAL_WARM_USERS} AS BIGINT) AS n_no_repeat,
       CAST({N_VAL_WARM_USERS} AS BIGINT) AS n_sorted""")
def recs_subset_contract(spark, sf):
    _, val, model = _fitted(spark, sf)
    return _list_props(A.recommend_users(model, K, val), "user", "item")


@register(with_(SPLIT) + f"""
SELECT CAST({N_TRAIN_USERS} AS BIGINT) AS n_users,
       CAST(least(10, {N_TRAIN_ITEMS}) AS INTEGER) AS len_min,
       CAST(least(10, {N_TRAIN_ITEMS}) AS INTEGER) AS len_max,
       CAST({N_TRAIN_USERS} AS BIGINT) AS n_no_repeat, CAST({N_TRAIN_USERS} AS BIGINT) AS n_sorted""")
def recs_users_contract(spark, sf):
    return _list_props(A.recommend_users(_fitted(spark, sf)[2], 10), "user", "item")


@register(with_(SPLIT) + f"""
SELECT CAST({N_TRAIN_ITEMS} AS BIGINT) AS n_items,
       CAST(least(10, {N_TRAIN_USERS}) AS INTEGER) AS len_min,
       CAST(least(10, {N_TRAIN_USERS}) AS INTEGER) AS len_max,
       CAST({N_TRAIN_ITEMS} AS BIGINT) AS n_no_repeat, CAST({N_TRAIN_ITEMS} AS BIGINT) AS n_sorted""")
def recs_items_contract(spark, sf):
    return _list_props(A.recommend_items(_fitted(spark, sf)[2], 10), "item", "user")


@register(with_(SPLIT) + f"""
SELECT CAST({N_VAL_WARM_USERS} * least({K}, {N_TRAIN_ITEMS}) AS BIGINT) AS n_rows,
       CAST({N_VAL_WARM_USERS} AS BIGINT) AS n_users, CAST(0 AS INTEGER) AS pos_min,
       CAST(least({K}, {N_TRAIN_ITEMS}) - 1 AS INTEGER) AS pos_max""")
def recs_long_contract(spark, sf):
    _, val, model = _fitted(spark, sf)
    long = A.to_long(A.recommend_users(model, K, val))
    return long.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user").alias("n_users"),
                    F.min("pos").alias("pos_min"), F.max("pos").alias("pos_max"))


@register(with_(SPLIT) + f"""
SELECT CAST({N_VAL_WARM_USERS} * least({K}, {N_TRAIN_ITEMS}) AS BIGINT) AS n_rows,
       CAST((SELECT count(*) FROM {VAL_WARM}) AS BIGINT) AS n_label_rows""")
def recs_join_labels(spark, sf):
    """Left join of long recommendations to label rows: no row lost or
    duplicated, and every label row of a scored user reachable."""
    _, val, model = _fitted(spark, sf)
    long = A.to_long(A.recommend_users(model, K, val))
    lab = lb.labels(val, "full")
    joined = long.join(lab.withColumn("hit", F.lit(1)), ["user", "item"], "left")
    scored_users = long.select("user").distinct()
    return _row(joined.agg(F.count(F.lit(1)).alias("n_rows")),
                lab.join(scored_users, "user", "left_semi").agg(
                    F.count(F.lit(1)).alias("n_label_rows")))


@register(with_(SPLIT) + f"""
SELECT CAST({N_TRAIN_USERS} AS BIGINT) AS n_users, CAST({N_TRAIN_USERS} AS BIGINT) AS n_users_equal,
       CAST({N_TRAIN_ITEMS} AS BIGINT) AS n_items, CAST({N_TRAIN_ITEMS} AS BIGINT) AS n_items_equal""")
def model_roundtrip(spark, sf):
    """Save to the shared scratch folder, load, compare every factor."""
    model = _fitted(spark, sf)[2]
    path = scratch_path(spark, "model")
    io.save_model(model, path)
    loaded = io.load_model(path)

    def side(a, b, name):
        j = a.join(b.withColumnRenamed("features", "f2"), "id")
        return j.agg(F.count(F.lit(1)).alias(f"n_{name}s"),
                     F.sum((F.col("features") == F.col("f2")).cast("long")).alias(f"n_{name}s_equal"))
    return _row(side(model.userFactors, loaded.userFactors, "user"),
                side(model.itemFactors, loaded.itemFactors, "item"))


SWEEP_COMBOS = [("raw", RANK, 0.1, 1.0), ("drop", RANK, 0.1, 1.0)]
_SWEPT: dict = {}


def _swept(spark, sf):
    """The two-point validation sweep, run once per session and data."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SWEPT:
        train, val, _ = _fitted(spark, sf)
        combos = spark.createDataFrame(SWEEP_COMBOS, "variant string, rank int, reg_param double, "
                                                     "alpha double")
        _SWEPT[key] = sw.run_sweep(train, val, combos, k=K, parallelism=2, max_iter=ITERS).cache()
    return _SWEPT[key]


@register(with_(SPLIT) + """,
warm_drop AS (SELECT DISTINCT user_id FROM train WHERE count >= 2)
SELECT variant, CAST(10 AS INTEGER) AS rank, CAST(0.1 AS DOUBLE) AS reg_param, CAST(1.0 AS DOUBLE) AS alpha,
  CAST(500 AS INTEGER) AS k,
  CAST(n_scored AS BIGINT) AS n_users_scored,
  CAST((SELECT count(DISTINCT user_id) FROM val) - n_scored AS BIGINT) AS n_users_cold,
  true AS metrics_in_range, true AS rmse_positive
FROM (SELECT 'raw' AS variant,
        (SELECT count(DISTINCT user_id) FROM val WHERE user_id IN (SELECT user_id FROM train)) AS n_scored
      UNION ALL
      SELECT 'drop', (SELECT count(DISTINCT user_id) FROM val WHERE user_id IN (SELECT user_id FROM warm_drop)))""")
def sweep_results(spark, sf):
    """A two-point sweep (raw counts vs count-1 rows dropped) through the
    resumable sweep runner; users without factors are reported, not lost."""
    res = _swept(spark, sf)
    in01 = [(F.col(c) >= 0) & (F.col(c) <= 1) for c in ("precision_at_10", "precision_at_k", "map", "ndcg_at_k")]
    ok = in01[0]
    for c in in01[1:]:
        ok = ok & c
    return res.select("variant", "rank", "reg_param", "alpha", "k", "n_users_scored", "n_users_cold",
                      ok.alias("metrics_in_range"),
                      ((F.col("rmse_counts") > 0) & (F.col("rmse_preference") > 0)).alias("rmse_positive"))


@register()
def als_evaluate(spark, sf):
    """The flagship evaluation row (metric values are model output: rows only)."""
    from reclab.plans.evaluate import flagship

    return flagship(spark, sf)


@register(with_(SPLIT) + f"""
SELECT CAST({N_VAL_WARM_PAIRS} AS BIGINT) AS n_rows, true AS pref_below_counts""")
def als_rmse_contract(spark, sf):
    """RMSE of implicit-ALS scores against raw counts (what the reference
    logged; scores live near 0..1, so it barely moves across models) and
    against the 0/1 preference the model actually fits."""
    from reclab.operators import metrics as mt

    _, val, model = _fitted(spark, sf)
    pred = A.score(model, val, "drop").withColumn("pref", F.lit(1.0)).cache()
    counts = mt.rmse(pred, "count", "prediction", digits=None)
    pref = mt.rmse(pred, "pref", "prediction", digits=None).select(F.col("rmse").alias("rmse_pref"))
    both = _row(counts, pref)
    return both.select("n_rows", (F.col("rmse_pref") < F.col("rmse")).alias("pref_below_counts"))


@register()
def final_test_eval(spark, sf):
    """Pick the best of the two-point sweep on validation by MAP, refit, and
    score on the test split (values are model output: rows only)."""
    from reclab.plans.evaluate import final_test

    train, _, _ = _fitted(spark, sf)
    _, _, (_, _, test) = data.formatted(spark, sf)
    best_row = sw.best(_swept(spark, sf)).first()
    return final_test(train, test, best_row, k=K, max_iter=ITERS)


@register(with_(SPLIT) + f"""
SELECT CAST(count(*) AS BIGINT) AS n_users, CAST(0 AS BIGINT) AS n_seen_left,
       CAST(count(*) AS BIGINT) AS n_users_dense_pos,
       CAST(sum(least({K}, {N_TRAIN_ITEMS} - n_seen)) AS BIGINT) AS n_rows,
       CAST(min(least({K}, {N_TRAIN_ITEMS} - n_seen)) AS BIGINT) AS len_min,
       CAST(max(least({K}, {N_TRAIN_ITEMS} - n_seen)) AS BIGINT) AS len_max
FROM (SELECT user_id, count(DISTINCT track_id) AS n_seen FROM train
      WHERE user_id IN (SELECT user_id FROM val) GROUP BY user_id) WHERE {N_TRAIN_ITEMS} > n_seen""")
def recs_exclude_seen_contract(spark, sf):
    """The best 500 unseen items of each validation user, or all that are left
    (lengths follow from the train pairs); none was seen, positions are 0..n-1."""
    train, val, model = _fitted(spark, sf)
    recs = A.recommend_unseen(model, K, val, train).cache()
    per_user = recs.groupBy("user").agg(F.max("pos").alias("mx"), F.count(F.lit(1)).alias("n"))
    return _row(per_user.agg(F.count(F.lit(1)).alias("n_users"),
                             F.sum((F.col("mx") == F.col("n") - 1).cast("long")).alias("n_users_dense_pos"),
                             F.sum("n").alias("n_rows"), F.min("n").alias("len_min"), F.max("n").alias("len_max")),
                recs.join(train, ["user", "item"], "left_semi").agg(F.count(F.lit(1)).alias("n_seen_left")))


# ---- users without any history ------------------------------------------------

COLD_USERS = f"({h("'cold:' || user_id")} % 5) = 0"
COLD_TRAIN = f"""seen_train AS (SELECT * FROM train WHERE NOT {COLD_USERS})"""


def _cold_user_splits(spark, sf):
    """Formatted train without a fifth of the users (by hash), and val with
    all of its users: the missing ones are cold."""
    from reclab.functions.hashing import bucket

    train, val, _ = data.splits(spark, sf)
    gone = bucket(5, F.concat(F.lit("cold:"), F.col("user_id"))) == 0
    return train.where(~gone), val


@register(with_(SPLIT, COLD_TRAIN, """pop AS (
  SELECT track_id, pos FROM (
    SELECT track_id, row_number() OVER (ORDER BY score DESC, track_id) - 1 AS pos
    FROM (SELECT track_id, count(*) AS score FROM seen_train GROUP BY track_id)) WHERE pos < 50)""",
    """hits AS (SELECT v.user_id, count(p.pos) FILTER (p.pos < 10) AS h10, count(p.pos) AS h50,
    count(*) AS m, v.user_id IN (SELECT user_id FROM seen_train) AS scored
  FROM (SELECT DISTINCT user_id, track_id FROM val) v LEFT JOIN pop p USING (track_id) GROUP BY v.user_id)""",
    """modes AS (SELECT 'drop' AS cold UNION ALL SELECT 'zero')""") + """
SELECT cold, CAST(count(*) FILTER (scored) AS BIGINT) AS n_users_scored,
  CAST(count(*) FILTER (NOT scored) AS BIGINT) AS n_users_cold,
  round(avg(CASE WHEN scored THEN h10 / 10 WHEN cold = 'zero' THEN 0 END), 5) AS precision_at_10,
  round(avg(CASE WHEN scored THEN h50 / m WHEN cold = 'zero' THEN 0 END), 5) AS recall_at_50
FROM hits, modes GROUP BY cold""")
def metric_cold_users(spark, sf):
    """Per-user lists exist for warm users only; a fifth of the users has no
    history.  Both modes count them; only ``zero`` averages over them."""
    from reclab.operators import metrics as mt
    from reclab.operators.popularity import popularity_topk

    train, val = _cold_user_splits(spark, sf)
    top = popularity_topk(train, 50, user_col="user_id", item_col="track_id")
    lists = top.agg(F.collect_list(F.struct("pos", F.col("track_id").alias("item"))).alias("l"))  # 50 entries
    warm = (val.select("user_id").distinct().join(train.select("user_id").distinct(), "user_id", "left_semi")
            .select(F.col("user_id").alias("user"), F.lit(1).alias("_k")))
    recs = (warm.join(F.broadcast(lists.withColumn("_k", F.lit(1))), "_k")
            .select("user", F.explode("l").alias("r")).select("user", "r.pos", "r.item"))
    lab = lb.labels(data.string_labels(val), "full")
    out = None
    for cold in ("drop", "zero"):
        m = mt.ranking_metrics(recs, lab, ks=(10, 50), cold=cold).select(
            F.lit(cold).alias("cold"), "n_users_scored", "n_users_cold", "precision_at_10", "recall_at_50")
        out = m if out is None else out.unionByName(m)
    return out


_COLD_FITTED: dict = {}


def _cold_fitted(spark, sf):
    from reclab.operators import index as ix

    key = (spark.sparkContext.applicationId, sf)
    if key not in _COLD_FITTED:
        train, val = _cold_user_splits(spark, sf)
        _, _, (train, val, _) = ix.index_splits(train, val, val.limit(0), fit_on="all")
        train, val = materialise(train, "train"), materialise(val, "val")
        _COLD_FITTED[key] = (train, val, A.fit_als(train, rank=RANK, max_iter=ITERS, seed=0))
    return _COLD_FITTED[key]


# ---- folds, best row, formatted round trip --------------------------------------


@register(with_(SPLIT, COLD_TRAIN) + """,
warm AS (SELECT count(*) AS n FROM val WHERE user_id IN (SELECT user_id FROM seen_train)
         AND track_id IN (SELECT track_id FROM seen_train))
SELECT CAST((SELECT count(*) FROM val) AS BIGINT) AS n_rows_nan,
       CAST((SELECT count(*) FROM val) - (SELECT n FROM warm) AS BIGINT) AS n_rows_missing,
       CAST((SELECT n FROM warm) AS BIGINT) AS n_rows_drop""")
def als_cold_rows(spark, sf):
    """Pairs of users without history: NaN or dropped."""
    _, val, model = _cold_fitted(spark, sf)
    nan = A.score(model, val, "nan").agg(
        F.count(F.lit(1)).alias("n_rows_nan"),
        F.sum(F.isnan("prediction").cast("long")).alias("n_rows_missing"))
    drop = A.score(model, val, "drop").agg(F.count(F.lit(1)).alias("n_rows_drop"))
    return _row(nan, drop)


@register(with_(SPLIT, COLD_TRAIN) + """
SELECT CAST(count(DISTINCT user_id) FILTER (user_id IN (SELECT user_id FROM seen_train)) AS BIGINT) AS n_users_scored,
       CAST(count(DISTINCT user_id) FILTER (user_id NOT IN (SELECT user_id FROM seen_train)) AS BIGINT) AS n_users_cold,
       true AS rmse_positive FROM val""")
def sweep_cold_users(spark, sf):
    """One sweep point on the split with cold users: they are counted."""
    train, val, _ = _cold_fitted(spark, sf)
    point = spark.createDataFrame([("log1p", RANK, 0.1, 1.0)], "variant string, rank int, reg_param double, alpha double")
    res = sw.run_sweep(train, val, point, k=K, max_iter=ITERS, split="cold")
    return res.select("n_users_scored", "n_users_cold",
                      ((F.col("rmse_counts") > 0) & (F.col("rmse_preference") > 0)).alias("rmse_positive"))


@register(with_(SPLIT) + """
SELECT variant, CAST((SELECT count(DISTINCT user_id) FROM val) AS BIGINT) AS n_label_users,
       CAST(n AS BIGINT) AS n_users_scored, true AS metrics_in_range
FROM (SELECT v.variant, (SELECT count(DISTINCT user_id) FROM val WHERE user_id IN (
        SELECT user_id FROM train WHERE count >= CASE WHEN v.variant = 'drop' THEN 2 ELSE 1 END)) AS n
      FROM (VALUES ('raw'), ('drop'), ('log'), ('log1p'), ('cap'), ('binary')) v(variant))""")
def als_strategies(spark, sf):
    """Every count strategy fitted with ALS and scored on one user set: which
    users keep factors follows from the rows a strategy keeps (``log`` turns a
    count of 1 into 0 but keeps the row)."""
    from reclab.operators import counts as cn

    train, val, _ = _fitted(spark, sf)
    points = sw.grid(spark, [RANK], [0.1], [1.0], cn.HOWS)
    res = sw.run_sweep(train, val, points, k=K, max_iter=ITERS, parallelism=2)
    cols = ("precision_at_10", "precision_at_k", "map", "ndcg_at_k")
    ok = F.lit(True)
    for c in cols:
        ok = ok & (F.col(c) > 0) & (F.col(c) <= 1)
    return res.select("variant", (F.col("n_users_scored") + F.col("n_users_cold")).alias("n_label_users"),
                      "n_users_scored", ok.alias("metrics_in_range"))


@register(with_(SPLIT) + """
SELECT CAST(5 AS BIGINT) AS n_folds, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT user_id) AS BIGINT) AS n_users, true AS mean_is_average, true AS best_is_argmax
FROM train""")
def cv_contract(spark, sf):
    """Five-fold cross-validation of two grid points: folds cover every train
    row once, the mean row is the average of its folds, and the best row is
    the arg-max of the stored ones."""
    train, _, _ = _fitted(spark, sf)
    points = sw.grid(spark, [RANK], [0.1, 1.0], [1.0])
    folds = sw.with_folds(train, 5)
    each = sw.cross_validate(train, points, folds=5, k=K, max_iter=ITERS, per_fold=True).cache()
    rows = each.collect()  # ten result rows
    by = {}
    for r in rows:
        by.setdefault(r["reg_param"], []).append(r["map"])
    means = {k: sum(v) / len(v) for k, v in by.items()}
    mean = {r["reg_param"]: r["map"] for r in each.groupBy("reg_param").agg(F.avg("map").alias("map")).collect()}
    ok = all(len(v) == 5 for v in by.values()) and all(abs(mean[k] - means[k]) < 1e-9 for k in means)
    top = sw.best(each).first()["map"] == max(r["map"] for r in rows)
    sizes = folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    return _row(sizes.agg(F.count(F.lit(1)).alias("n_folds"), F.sum("n").alias("n_rows")),
                train.agg(F.countDistinct("user").alias("n_users"))).withColumns(
                    {"mean_is_average": F.lit(ok), "best_is_argmax": F.lit(top)})


@register(with_(SPLIT) + """
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT track_id) AS BIGINT) AS n_items, CAST(sum(count) AS DOUBLE) AS total,
       false AS has_metadata, true AS refuses_overwrite
FROM split GROUP BY split""")
def formatted_roundtrip(spark, sf):
    """Formatted splits written, refused a second time, and read back with
    their declared schema, without column metadata."""
    from pyspark.errors import AnalysisException

    from reclab.sources.schema import FORMATTED, check_schema

    _, _, frames = data.formatted(spark, sf)
    out = None
    for name, df in zip(("train", "val", "test"), frames):
        path = scratch_path(spark, f"formatted-{name}")
        io.write_table(df, path)
        try:
            io.write_table(df, path)
            refused = False
        except AnalysisException:
            refused = True
        back = check_schema(spark.read.parquet(path), FORMATTED)
        meta = any(f.metadata for f in spark.read.parquet(path).schema.fields)
        row = back.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user").alias("n_users"),
                       F.countDistinct("item").alias("n_items"), F.sum("count").alias("total")).select(
            F.lit(name).alias("split"), "*", F.lit(meta).alias("has_metadata"),
            F.lit(refused).alias("refuses_overwrite"))
        out = row if out is None else out.unionByName(row)
    return out
