"""Ranking metrics: hand-computed cases and a cross-check with RankingMetrics."""

import pytest
from pyspark.sql import functions as F

from reclab.operators import metrics as mt


def _frames(spark, cases):
    recs, labs = [], []
    for u, (pred, lab) in enumerate(cases):
        recs += [(u, i, p) for i, p in enumerate(pred)]
        labs += [(u, x, 1) for x in lab]
    r = spark.createDataFrame(recs, "user int, pos int, item int")
    lschema = "user int, item int, count long"
    return r, spark.createDataFrame(labs, lschema)


def test_case_one(spark):
    r, lab = _frames(spark, [([1, 2, 3], [1, 9]), ([4], [4])])
    row = mt.ranking_metrics(r, lab, ks=(2, 3), digits=8).first()
    assert row["precision_at_2"] == pytest.approx(0.5)
    assert row["map"] == pytest.approx(0.75)
    assert row["ndcg_at_3"] == pytest.approx(0.80657360, abs=1e-8)


def test_case_two(spark):
    r, lab = _frames(spark, [([1, 2, 3, 4, 5], [1, 3, 5])])
    row = mt.ranking_metrics(r, lab, ks=(2,), map_k=(2,), digits=8).first()
    assert row["map"] == pytest.approx(0.75555556, abs=1e-8)
    assert row["map_at_2"] == pytest.approx(0.5)
    assert row["precision_at_2"] == pytest.approx(0.5)
    assert row["recall_at_2"] == pytest.approx(0.33333333, abs=1e-8)
    assert row["ndcg_at_2"] == pytest.approx(0.61314719, abs=1e-8)


def test_empty_label_user_counts_as_zero(spark):
    r, lab = _frames(spark, [([1, 2, 3], []), ([1, 2], [1])])
    row = mt.ranking_metrics(r, lab, ks=(2, 3), digits=8, include_unlabeled=True).first()
    assert row["precision_at_2"] == pytest.approx(0.25)
    assert row["map"] == pytest.approx(0.5)
    assert row["ndcg_at_3"] == pytest.approx(0.5)
    assert row["n_users_scored"] == 2


def test_cold_users_drop_or_zero(spark):
    r, lab = _frames(spark, [([1], [1])])
    lab = lab.unionByName(spark.createDataFrame([(7, 1, 1)], "user int, item int, count long"))
    drop = mt.ranking_metrics(r, lab, ks=(1,)).first()
    zero = mt.ranking_metrics(r, lab, ks=(1,), cold="zero").first()
    assert (drop["n_users_scored"], drop["n_users_cold"]) == (1, 1)
    assert (zero["n_users_scored"], zero["n_users_cold"]) == (1, 1)
    assert drop["precision_at_1"] == 1.0 and zero["precision_at_1"] == 0.5


def test_repeated_labels_count_once(spark):
    r, lab = _frames(spark, [([1, 2], [1, 1, 3])])
    row = mt.ranking_metrics(r, lab, ks=(1, 2)).first()
    assert row["precision_at_1"] == 1.0 and row["recall_at_2"] == 0.5 and row["map"] == 0.5


def test_global_list_equals_per_user_list(spark):
    r, lab = _frames(spark, [([1, 2, 3], [1, 3]), ([1, 2, 3], [2]), ([1, 2, 3], [9])])
    per_user = mt.ranking_metrics(r, lab, ks=(2, 3), map_k=(2,)).first().asDict()
    glist = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "pos int, item int")
    shared = mt.ranking_metrics(glist, lab, ks=(2, 3), map_k=(2,)).first().asDict()
    assert per_user == shared


def test_equals_spark_ranking_metrics(spark):
    """Cross-check on the sf0.001 split with a popularity top-20 list."""
    from pyspark.mllib.evaluation import RankingMetrics

    from reclab.operators import labels as lb
    from reclab.operators.popularity import popularity_topk
    from reclab.plans import data
    from tests.conftest import SF_SMALL

    train, val, _ = data.splits(spark, SF_SMALL)
    top = popularity_topk(train, 20, user_col="user_id", item_col="track_id")
    lab = lb.labels(data.string_labels(val), "full")
    ours = mt.ranking_metrics(top.select(F.col("track_id").alias("item"), "pos"), lab,
                              ks=(5, 20), digits=None).first()
    pred = [r["track_id"] for r in top.orderBy("pos").collect()]
    per_user = lab.groupBy("user").agg(F.collect_list("item").alias("l")).collect()
    rm = RankingMetrics(spark.sparkContext.parallelize([(pred, r["l"]) for r in per_user]))
    assert ours["precision_at_5"] == pytest.approx(rm.precisionAt(5), abs=1e-12)
    assert ours["map"] == pytest.approx(rm.meanAveragePrecision, abs=1e-12)
    assert ours["ndcg_at_20"] == pytest.approx(rm.ndcgAt(20), abs=1e-12)
    assert ours["recall_at_20"] == pytest.approx(rm.recallAt(20), abs=1e-12)


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (2.0, float("nan"))], "count double, prediction double")
    row = mt.rmse(df).first()
    assert row["n_rows"] == 2 and row["rmse"] == pytest.approx(0.70711)


def test_grouped_lists_equal_separate_runs(spark):
    r, lab = _frames(spark, [([1, 2, 3], [1, 3]), ([1, 2, 3], [2]), ([1, 2, 3], [9])])
    lists = {"a": [1, 2, 3], "b": [3, 9, 4]}
    rows = [(g, i, it) for g, items in lists.items() for i, it in enumerate(items)]
    grouped = spark.createDataFrame(rows, "g string, pos int, item int")
    both = {x["g"]: x.asDict() for x in mt.ranking_metrics(grouped, lab, ks=(2,), group_col="g").collect()}
    for g, items in lists.items():
        one = spark.createDataFrame([(i, it) for i, it in enumerate(items)], "pos int, item int")
        alone = mt.ranking_metrics(one, lab, ks=(2,)).first().asDict()
        assert {k: v for k, v in both[g].items() if k != "g"} == alone
    per_user = spark.createDataFrame([(g, u, i, it) for g, items in lists.items() for u in range(3)
                                      for i, it in enumerate(items)], "g string, user int, pos int, item int")
    pu = {x["g"]: x.asDict() for x in mt.ranking_metrics(per_user, lab, ks=(2,), group_col="g").collect()}
    assert pu == both


def test_leads_and_hits_score_as_the_whole_lists(spark):
    """Users 0..3 of 30 items each; user 3 hits nothing; labels repeat, hold an
    item outside the lists and a user without one."""
    recs = spark.createDataFrame([(u, p, (p * 7 + u) % 30) for u in range(4) for p in range(30)],
                                 "user int, pos int, item int")
    labels = spark.createDataFrame([(0, 3), (0, 3), (0, 9), (1, 1), (2, 28), (2, 99), (3, 77), (9, 4)],
                                   "user int, item int")
    kept = mt.leads_and_hits(recs, labels)
    assert kept.count() == 4 + 4 - 1  # four leads and four hits; one hit leads its list
    for lab in (labels, labels.where("item > 5"), labels.where("item > 1000")):
        assert (mt.ranking_metrics(kept, lab, ks=(5, 30)).collect()
                == mt.ranking_metrics(recs, lab, ks=(5, 30)).collect())
