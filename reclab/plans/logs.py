"""Queries over the results log and the other sinks: what they write is read
back and compared with SQL over the tables it came from."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from reclab.operators import labels as lb
from reclab.operators import sweep as sw
from reclab.plans import data
from reclab.plans.oracle import SPLIT, with_
from reclab.plans.registry import register
from reclab.session import materialise, scratch_path, scratch_released
from reclab.sources import io
from reclab.sources.schema import RESULTS

WRITERS = 8
THRESHOLDS = range(1, 9)


def _thresholds(splits) -> list[tuple]:
    """(split, least count, users, mean count) of the rows with at least that
    count, where there are any.  A user has such a row if the greatest count
    does, so a row enters once and not once for every threshold."""
    means = splits.groupBy("split").agg(*[
        F.round(F.avg(F.when(F.col("count") >= m, F.col("count"))), 5).alias(f"m{m}") for m in THRESHOLDS]).collect()
    top = splits.where("user_id IS NOT NULL").groupBy("split", "user_id").agg(F.max("count").alias("top"))
    users = {r["split"]: r for r in top.groupBy("split").agg(*[
        F.count(F.when(F.col("top") >= m, True)).alias(f"u{m}") for m in THRESHOLDS]).collect()}  # a row per split
    return [(r["split"], float(m), users[r["split"]][f"u{m}"] if r["split"] in users else 0, r[f"m{m}"])
            for r in means for m in THRESHOLDS if r[f"m{m}"] is not None]


@register(with_(SPLIT) + """
SELECT split, CAST(min_count AS DOUBLE) AS min_count, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users_scored,
  round(avg(count), 5) AS rmse_counts, CAST(1 AS BIGINT) AS n_commits
FROM split, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS min_count) WHERE count >= min_count GROUP BY ALL""")
def results_log(spark, sf):
    """Users and mean count of every split under eight thresholds, each
    appended to a results log twice by eight concurrent writers and read
    back: one commit of each is there."""
    path = scratch_path(spark, "log")
    splits = data.split_table(spark, sf)
    filled = [{**dict.fromkeys(RESULTS.names), "variant": "drop", "rank": 0, "reg_param": 0.0, "alpha": 0.0, "k": 0,
               "split": split, "labels": "full", "max_iter": 0, "seed": 0, "min_count": least,
               "cap": 0.0, "n_users_scored": users, "rmse_counts": mean, "data_key": sf}
              for split, least, users, mean in _thresholds(splits)]

    def put(row):
        one = spark.createDataFrame([tuple(row[n] for n in RESULTS.names)], RESULTS)
        return io.append_results(one, path, io.result_key(row))

    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        list(pool.map(put, filled * 2))
    return (io.read_results(spark, path).groupBy("split", "min_count", "n_users_scored", "rmse_counts")
            .agg(F.count(F.lit(1)).alias("n_commits")))


@register(with_(SPLIT) + """
SELECT user_id, track_id, CAST(sum(count) AS BIGINT) AS count FROM val GROUP BY user_id, track_id""")
def csv_roundtrip(spark, sf):
    """Validation labels written as CSV with a header and read with a schema."""
    _, val, _ = data.splits(spark, sf)
    path = scratch_path(spark, "csv")
    io.write_csv(lb.labels(data.string_labels(val)).select(
        F.col("user").alias("user_id"), F.col("item").alias("track_id"), "count"), path)
    return (spark.read.option("header", True).option("enforceSchema", False)
            .schema("user_id string, track_id string, count long").csv(path))


@register(with_(SPLIT) + """
SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_users, true AS fitted_once, true AS equal_factors,
  CAST(0 AS BIGINT) AS n_pending, CAST(1 AS BIGINT) AS n_results FROM train""")
def train_skips_saved_model(spark, sf):
    """A point that is saved is loaded and not fitted again, and a point that is
    in the log is not evaluated again."""
    _, _, (train, val, _) = data.formatted(spark, sf)
    with scratch_released():
        train, val = materialise(train, "train"), materialise(val, "val")
        models, log = scratch_path(spark, "models"), scratch_path(spark, "log")
        points = sw.grid(spark, [5], [0.1], [1.0])
        point, setting = points.first().asDict(), sw.Setting(k=50, max_iter=3)
        key = sw.fingerprint(train)
        path = sw.model_path(models, point["variant"], point["rank"], point["reg_param"], point["alpha"], key, setting)
        before = io.model_exists(spark, path)
        first = sw.run_sweep(train, val, points, k=50, max_iter=3, models_dir=models, results_path=log)
        fs, jpath = io._jvm_fs(spark, f"{path}/metadata")
        stamp = fs.getFileStatus(jpath).getModificationTime()
        new = sw.fit_point(train, point, setting)
        old = sw.fit_point(train, point, setting, path)  # loads
        same_stamp = fs.getFileStatus(jpath).getModificationTime() == stamp
        pairs = new.userFactors.join(old.userFactors.withColumnRenamed("features", "f"), "id")
        apart = F.aggregate(F.zip_with("features", "f", lambda x, y: F.abs(x - y).cast("double")), F.lit(0.0),
                            lambda s, x: F.greatest(s, x))
        got = pairs.agg(F.count(F.lit(1)).alias("n"), F.max(apart).alias("apart")).first()
        left = sw.pending(points, io.read_results(spark, log), setting, key).count()
        sw.run_sweep(train, val, points, k=50, max_iter=3, models_dir=models, results_path=log)
        return spark.createDataFrame(
            [(got["n"], not before and same_stamp and first.count() == 1, got["apart"] < 1e-4, left,
              io.read_results(spark, log).count())],
            "n_users long, fitted_once boolean, equal_factors boolean, n_pending long, n_results long")
