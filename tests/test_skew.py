"""One user holding a third of all label rows: positions and metrics stay
exact, and nothing gathers that user's labels into one array."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reclab.operators import labels as lb
from reclab.operators import metrics as mt


@pytest.fixture(scope="module")
def skewed(spark):
    hot = spark.range(0, 6000).select(F.lit(0).alias("user"), F.col("id").cast("int").alias("item"),
                                      (F.col("id") % 7 + 1).alias("count"))
    rest = spark.range(0, 12000).select((F.col("id") % 400 + 1).cast("int").alias("user"),
                                        (F.col("id") * 13 % 5000).cast("int").alias("item"),
                                        (F.col("id") % 5 + 1).alias("count"))
    return hot.unionByName(rest).repartition(16).cache()


def test_ordered_positions_exact(spark, skewed):

    ours = lb.ordered_labels(skewed)
    base = lb.labels(skewed)
    w = Window.partitionBy("user").orderBy(F.desc("count"), F.asc("item"))
    ref = base.withColumn("label_pos", (F.row_number().over(w) - 1).cast("int"))
    cols = ["user", "item", "count", "label_pos"]
    assert ours.select(cols).exceptAll(ref.select(cols)).count() == 0
    assert ours.count() == base.count()


def test_metrics_exact_with_heavy_user(spark, skewed):
    from pyspark.mllib.evaluation import RankingMetrics

    lab = lb.labels(skewed)
    recs = spark.range(0, 401).select(F.col("id").cast("int").alias("user")).withColumn(
        "pos", F.explode(F.sequence(F.lit(0), F.lit(49)))).withColumn(
        "item", ((F.col("user") * 31 + F.col("pos") * 17) % 6000).cast("int"))
    ours = mt.ranking_metrics(recs, lab, ks=(10, 50), digits=None).first()
    pred = recs.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("p"))
    labs = lab.groupBy("user").agg(F.collect_list("item").alias("l"))
    pairs = pred.join(labs, "user").select(F.col("p.item").alias("p"), "l").rdd.map(
        lambda r: (r["p"], r["l"]))
    rm = RankingMetrics(pairs)
    assert ours["map"] == pytest.approx(rm.meanAveragePrecision, abs=1e-12)
    assert ours["ndcg_at_50"] == pytest.approx(rm.ndcgAt(50), abs=1e-12)
    assert ours["precision_at_10"] == pytest.approx(rm.precisionAt(10), abs=1e-12)


def test_top_tied_with_heavy_user(spark, skewed):
    tied = lb.labels(skewed, "top_tied").where("user = 0").count()
    assert tied == skewed.where("user = 0 and count = 7").count()
