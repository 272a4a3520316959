"""Count transforms, signal checks, labels."""

import math

import pytest

from reclab.operators import counts as cn
from reclab.operators import labels as lb


def test_log_edges(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 1, 1), (0, 2, 2)], "user int, item int, count long")
    got = {r["item"]: r["count"] for r in cn.transform_counts(df, "log").collect()}
    assert got == {1: 0.0, 2: pytest.approx(math.log(2))}
    got = {r["item"]: r["count"] for r in cn.transform_counts(df, "log1p").collect()}
    assert got == {1: pytest.approx(math.log(2)), 2: pytest.approx(math.log(3))}
    assert {r["item"] for r in cn.transform_counts(df, "drop").collect()} == {2}
    assert {r["count"] for r in cn.transform_counts(df, "binary").collect()} == {1.0}
    assert {r["count"] for r in cn.transform_counts(df, "cap", cap=1.5).collect()} == {1.0, 1.5}


def test_zero_signal_named(spark):
    df = spark.createDataFrame([(0, 0, 1), (1, 1, 1)], "user int, item int, count long")
    logged = cn.transform_counts(df, "log")
    with pytest.raises(ValueError, match="every rating is 0"):
        cn.check_signal(logged)
    nulls = spark.createDataFrame([(0, 0, None)], "user int, item int, count double")
    with pytest.raises(ValueError, match="NULL or NaN"):
        cn.check_signal(nulls)


def test_report_counts(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 1)],
                               "user_id string, track_id string, count long")
    rep = {r["how"]: r for r in cn.transform_report(df).collect()}
    assert rep["drop"]["rows_kept"] == 1 and rep["drop"]["users_kept"] == 1
    assert rep["log"]["rows_zero"] == 2 and rep["raw"]["rows_kept"] == 3


def test_tied_top_counts(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 11, 5), (1, 12, 2), (2, 13, 1)],
                               "user int, item int, count long")
    tied = sorted((r["user"], r["item"]) for r in lb.labels(df, "top_tied").collect())
    assert tied == [(1, 10), (1, 11), (2, 13)]
    full = lb.labels(df, "full").count()
    assert full == 4
    top = sorted((r["user"], r["item"]) for r in lb.top_item_per_user(df).collect())
    assert top == [(1, 10), (2, 13)]
    pos = {(r["user"], r["item"]): r["label_pos"] for r in lb.ordered_labels(df).collect()}
    assert pos == {(1, 10): 0, (1, 11): 1, (1, 12): 2, (2, 13): 0}
