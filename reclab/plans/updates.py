"""Queries for data that keeps coming: ids that never move, factors without a
refit, and whether a change of the lists is more than luck."""

from __future__ import annotations

from pyspark.sql import functions as F

from reclab.operators import foldin as fi
from reclab.operators import labels as lb
from reclab.operators import significance as sg
from reclab.operators.dictionary import Dictionary
from reclab.operators.popularity import popularity_topk
from reclab.plans import data
from reclab.plans.contracts import _fitted
from reclab.plans.oracle import SPLIT, with_
from reclab.plans.registry import register
from reclab.session import materialise, scratch_path, scratch_released

BATCHES = ("train", "val", "test")
REPLICATES = 200


def _grown(col: str) -> str:
    return with_(SPLIT) + f"""
, batches AS (SELECT {col} AS label, split, count(*) AS freq FROM split GROUP BY ALL),
firsts AS (SELECT *, CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END AS b FROM batches
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY b) = 1),
versions AS (SELECT b, CAST(row_number() OVER (ORDER BY b) AS INTEGER) AS version FROM (SELECT DISTINCT b FROM firsts))
SELECT label, CAST(row_number() OVER (ORDER BY b, freq DESC, label) - 1 AS INTEGER) AS idx,
  CAST(freq AS BIGINT) AS freq, version FROM firsts JOIN versions USING (b)"""


def _extended(spark, sf, col):
    growing = Dictionary(spark, scratch_path(spark, "dictionary"))
    table = data.split_table(spark, sf)
    for batch in BATCHES:
        growing.extend(table.where(F.col("split") == batch), col)
    growing.extend(table, col)  # nothing is new any more: no version
    return growing.mapping()


@register(_grown("user_id"))
def index_grown_users(spark, sf):
    """Users numbered batch by batch (train, then validation, then test)."""
    return _extended(spark, sf, "user_id")


@register(_grown("track_id"))
def index_grown_items(spark, sf):
    return _extended(spark, sf, "track_id")


_TOPS = """lab AS (SELECT DISTINCT user_id, track_id FROM val),
scores AS (SELECT track_id, count(*) AS a, sum(count) AS b FROM train GROUP BY track_id),
tops AS (SELECT track_id, row_number() OVER (ORDER BY a DESC, track_id) <= 50 AS in_a,
  row_number() OVER (ORDER BY b DESC, track_id) <= 50 AS in_b FROM scores),
pairs AS (SELECT user_id, CAST(sum(CASE WHEN in_a THEN 1 ELSE 0 END) AS BIGINT) AS a,
  CAST(sum(CASE WHEN in_b THEN 1 ELSE 0 END) AS BIGINT) AS b
  FROM lab LEFT JOIN tops USING (track_id) GROUP BY user_id)"""

_WEIGHT = " + ".join(f"CASE WHEN word >= {step} THEN 1 ELSE 0 END" for step in sg.STEPS)
_REPLICATES = f"""words AS (SELECT user_id, a, b, CAST(r AS INTEGER) AS replicate,
  ('0x' || substr(md5(':' || user_id || ':' || CAST(r // 4 AS VARCHAR)), CAST(r % 4 AS INTEGER) * 8 + 1, 8))::BIGINT AS word
  FROM pairs, (SELECT unnest(range({REPLICATES})) AS r)),
replicates AS (SELECT replicate, CAST(sum(w) AS BIGINT) AS weight, CAST(sum(w * a) AS BIGINT) AS sum_a,
  CAST(sum(w * b) AS BIGINT) AS sum_b
  FROM (SELECT *, {_WEIGHT} AS w FROM words) WHERE w > 0 GROUP BY replicate)"""


def _hit_pairs(spark, sf):
    """Hits of the 50 items with most listeners (a) and of the 50 with most
    plays (b) among every validation user's labels."""
    train, val, _ = data.splits(spark, sf)
    lab = lb.labels(data.string_labels(val)).select("user", "item").distinct()
    long = data.string_labels(train)
    for side, by in (("a", "users"), ("b", "count")):
        top = popularity_topk(long, 50, by).select("item", F.lit(1).cast("long").alias(f"in_{side}"))
        lab = lab.join(top, "item", "left")
    return lab.groupBy("user").agg(F.coalesce(F.sum("in_a"), F.lit(0)).alias("a"),
                                   F.coalesce(F.sum("in_b"), F.lit(0)).alias("b"))


@register(with_(SPLIT, _TOPS, _REPLICATES) + "SELECT * FROM replicates")
def bootstrap_replicates(spark, sf):
    return sg.replicates(_hit_pairs(spark, sf), REPLICATES)


@register(with_(SPLIT, _TOPS, _REPLICATES) + f"""
, d AS (SELECT (sum_b - sum_a) / weight AS d, row_number() OVER (ORDER BY (sum_b - sum_a) / weight) AS p FROM replicates)
SELECT CAST((SELECT count(*) FROM pairs) AS BIGINT) AS n_users, CAST(count(*) AS BIGINT) AS n_replicates,
  (SELECT round(avg(a), 6) FROM pairs) AS mean_a, (SELECT round(avg(b), 6) FROM pairs) AS mean_b,
  (SELECT round(avg(b - a), 6) FROM pairs) AS mean_diff,
  round(min(CASE WHEN p > 5 THEN d END), 6) AS diff_low, round(max(CASE WHEN p <= {REPLICATES} - 5 THEN d END), 6) AS diff_high,
  round(least(1.0, 2 * least(sum(CASE WHEN d <= 0 THEN 1 ELSE 0 END), sum(CASE WHEN d >= 0 THEN 1 ELSE 0 END)) / count(*)), 6)
    AS p_value FROM d""")
def significance_report(spark, sf):
    """Popularity by plays against popularity by listeners: difference in hits
    at 50, its 95 % interval and its share of contradicting replicates."""
    return sg.compare(_hit_pairs(spark, sf), REPLICATES)


@register(with_(SPLIT) + """
SELECT kind, n_keys, true AS gradient_zero, equals_fit FROM (
  SELECT 'train users' AS kind, CAST(count(DISTINCT user_id) AS BIGINT) AS n_keys, true AS equals_fit FROM train
  UNION ALL
  SELECT 'held-out users' AS kind, CAST(count(DISTINCT user_id) AS BIGINT) AS n_keys, CAST(NULL AS BOOLEAN) AS equals_fit
  FROM val WHERE track_id IN (SELECT track_id FROM train)
  UNION ALL
  SELECT 'held-out items' AS kind, CAST(count(DISTINCT track_id) AS BIGINT) AS n_keys, CAST(NULL AS BOOLEAN) AS equals_fit
  FROM val WHERE user_id IN (SELECT user_id FROM train))""")
def fold_in_contract(spark, sf):
    """Factors folded in: the gradient vanishes for every key, and for the
    training users they are the fitted model's own."""
    train, val, model = _fitted(spark, sf)
    reg, alpha = 0.1, 1.0  # of the fitted model
    out = []
    for kind, rows, key, other, factors in (
            ("train users", train, "user", "item", model.itemFactors),
            ("held-out users", val, "user", "item", model.itemFactors),
            ("held-out items", val, "item", "user", model.userFactors)):
        with scratch_released():
            folded = materialise(fi.fold_in(rows, factors, reg, alpha, key=key, other=other), "folded")
            slopes = materialise(fi.gradients(folded, rows, factors, reg, alpha, key=key, other=other), "slopes")
            got = slopes.agg(F.count(F.lit(1)).alias("n"), F.max("gradient").alias("g")).first()
            equal = None
            if kind == "train users":
                apart = F.aggregate(F.zip_with("features", "f", lambda x, y: F.abs(x - y).cast("double")), F.lit(0.0),
                                    lambda s, x: F.greatest(s, x))
                far = folded.join(model.userFactors.withColumnRenamed("features", "f"), "id").agg(
                    F.count(F.lit(1)).alias("n"), F.max(apart).alias("d")).first()
                equal = bool(far["n"] == got["n"] and far["d"] < 1e-3)
        out.append((kind, got["n"], bool(got["g"] < 1e-6), equal))
    return spark.createDataFrame(out, "kind string, n_keys long, gradient_zero boolean, equals_fit boolean")
