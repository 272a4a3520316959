"""Exact selection by key without a sort, and the sums behind the cold-start map."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reclab.operators import coldstart
from reclab.operators import split as sp
from reclab.operators.selection import smallest


def _md5(salt, user):
    return hashlib.md5(f"{salt}{user}".encode()).hexdigest()


@pytest.fixture(scope="module")
def users(spark):
    return spark.range(3000).select(F.concat(F.lit("U"), "id").alias("user_id")).repartition(7)


@pytest.mark.parametrize("n", [0, 1, 2, 499, 2999, 3000, 5000])
@pytest.mark.parametrize("digits,leaf", [(4, 10_000), (1, 1), (2, 20)])
def test_equals_the_sorted_list(spark, users, n, digits, leaf):
    key = F.md5(F.concat(F.lit("s"), F.col("user_id")))
    got = [r[0] for r in smallest(users, key, "user_id", n=n, digits=digits, leaf=leaf).collect()]
    every = sorted((f"U{i}" for i in range(3000)), key=lambda u: (_md5("s", u), u))
    assert sorted(got) == sorted(every[:n])


def test_fraction_rounds_half_to_even(spark):
    few = spark.createDataFrame([(f"u{i}",) for i in range(5)], "user_id string")
    assert sp.sample_users(few, fraction=0.5).count() == round(2.5) == 2
    assert sp.sample_users(few, fraction=1.0).count() == 5
    assert sp.sample_users(few.limit(0), fraction=0.5).count() == 0


def test_ties_and_null_keys(spark):
    rows = spark.createDataFrame([("aa", 3), ("aa", 1), ("aa", 2), ("b", 9), (None, 7)], "k string, t long")
    for digits in (1, 4):
        for n, want in ((1, [7]), (2, [1, 7]), (3, [1, 2, 7]), (4, [1, 2, 3, 7])):
            got = smallest(rows, F.col("k"), "t", n=n, digits=digits, leaf=1).collect()
            assert sorted(r["t"] for r in got) == want


def test_other_id_types_and_null_user(spark):
    ids = spark.createDataFrame([(i,) for i in range(40)] + [(None,)], "user_id int")
    got = [r[0] for r in sp.sample_users(ids, n=11).collect()]
    assert len(got) == 11 and None in got
    assert sorted(x for x in got if x is not None) == sorted(sorted(range(40), key=lambda i: _md5("", i))[:10])


def test_plan_has_no_exchange_and_no_written_copy(spark, tmp_out, users):
    users.write.parquet(f"{tmp_out}/users")
    sample = sp.sample_users(spark.read.parquet(f"{tmp_out}/users"), n=100)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert sample.count() == 100


def test_needs_exactly_one_size(spark, users):
    for sizes in ({}, {"n": 1, "fraction": 0.5}):
        with pytest.raises(ValueError):
            smallest(users, F.col("user_id"), "user_id", **sizes)


def test_normal_equations_equal_numpy(spark):
    from pyspark.ml.functions import array_to_vector

    rng = np.random.RandomState(0)
    x, y = rng.rand(60, 4), rng.rand(60, 3)
    design = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y, strict=True)],
                                   "x array<double>, features array<double>").repartition(9).select(
                                       array_to_vector("x").alias("x"), "features")
    xx, xy, n = coldstart.normal_equations(design, 3)
    ones = np.column_stack([x, np.ones(60)])
    assert n == 60 and np.allclose(xx, ones.T @ ones) and np.allclose(xy, ones.T @ y)
    with pytest.raises(ValueError):
        coldstart.normal_equations(design.limit(0), 3)
