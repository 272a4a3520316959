"""Splits, user sets, samples, unions."""

import pytest
from pyspark.sql import functions as F

from reclab.operators import split as sp
from reclab.plans import data
from tests.conftest import SF_SMALL


def test_holdout_matches_fixture_sizes(spark):
    df = data.split_table(spark, SF_SMALL)
    got = {r["split"]: (r["n_rows"], r["n_users"]) for r in sp.audit(df).collect()}
    # hashes of the prefixed string ids (U<custkey>, U<custkey>:T<partkey>)
    assert got == {"train": (4657, 150), "val": (255, 15), "test": (470, 26)}


def test_splits_disjoint_and_complete(spark):
    df = data.split_table(spark, SF_SMALL)
    train, val, test = sp.split_frames(df)
    assert train.count() + val.count() + test.count() == df.count()
    assert sp.audit(df).first()["n_users_val_and_test"] == 0
    keys = ["user_id", "track_id"]
    assert train.join(val, keys).count() == 0 and val.join(test, keys).count() == 0


def test_sample_exact_size_and_deterministic(spark):
    users = data.split_table(spark, SF_SMALL).select("user_id").distinct()
    a = sp.sample_users(users, fraction=0.2)
    b = sp.sample_users(users.repartition(5), fraction=0.2)
    assert a.count() == round(150 * 0.2) == 30
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert sp.sample_users(users, n=7, salt="s").count() == 7


def test_sample_needs_one_size(spark):
    users = spark.createDataFrame([("a",)], "user_id string")
    with pytest.raises(ValueError):
        sp.sample_users(users)


def test_subsample_keeps_all_heldout_users(spark):
    train, val, test = data.splits(spark, SF_SMALL)
    sub = sp.subsample(train, val, test, fraction=0.2)
    held = sp.union_users(val, test)
    assert held.join(sub.select("user_id").distinct(), "user_id", "left_anti").count() == 0
    only = sp.users_only_in(train, val, test)
    kept_only = sub.select("user_id").distinct().join(only, "user_id", "left_semi").count()
    assert kept_only == round(only.count() * 0.2)


def test_union_by_name_and_refusal(spark):
    a = spark.createDataFrame([("u", "t", 1)], "user_id string, track_id string, count long")
    b = a.select("user_id", "count", "track_id")
    u = sp.union_splits(a, b, names=("x", "y"))
    assert {tuple(r) for r in u.select("user_id", "track_id", "count").collect()} == {("u", "t", 1)}
    bad = spark.createDataFrame([("u", "t", 1)], "user_id string, song_id string, count long")
    with pytest.raises(ValueError, match="columns differ"):
        sp.union_splits(a, bad, names=("x", "y"))


def test_describe_typed(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "count long")
    row = sp.describe(df).first()
    assert (row["n"], row["mean"], row["stddev"], row["min"], row["max"]) == (3, 2.0, 1.0, 1, 3)


def test_repartition_by_key_caps_partitions(spark):
    df = data.split_table(spark, SF_SMALL).repartition(16, "user_id", "track_id")
    assert df.rdd.getNumPartitions() == 16
    # every user-item pair lives in exactly one partition
    per = df.withColumn("p", F.spark_partition_id()).groupBy("user_id", "track_id").agg(
        F.countDistinct("p").alias("n"))
    assert per.where("n > 1").count() == 0
