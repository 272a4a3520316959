"""What fits, writes and sweeps leave behind: no shuffle files, no blocks, no
intermediate tables."""

import gc
import re
import time

import pytest
from pyspark.sql import functions as F

from reclab import session
from reclab.operators import als as A
from reclab.operators import sweep as sw


def shuffles(spark):
    found = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().keySet().mkString(",")
    return {int(x) for x in found.split(",") if x}


def left(spark, before):
    for _ in range(20):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
        if not (new := shuffles(spark) - before):
            break
    return new


@pytest.fixture(scope="module")
def train(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if (u + i) % 3]
    return spark.createDataFrame(rows, "user int, item int, count double")


@pytest.mark.parametrize("implicit", [True, False])
def test_a_fit_leaves_its_factors_only(spark, train, implicit):
    before, blocks = shuffles(spark), set(spark.sparkContext._jsc.getPersistentRDDs())
    model = A.fit_als(train.repartition(3), rank=2, max_iter=4, implicit=implicit)
    assert not left(spark, before)
    assert not set(spark.sparkContext._jsc.getPersistentRDDs()) - blocks
    assert model.userFactors.count() == 30 and model.itemFactors.count() == 20 and model.rank == 2


def test_iterations_of_a_fit_are_cut(spark, train, monkeypatch):
    """The lineage is cut at each iteration; else all of them keep their files."""
    asked, real = {}, A.ALS

    def als(**options):
        asked.update(options)
        return real(**options)

    monkeypatch.setattr(A, "ALS", als)
    A.fit_als(train, rank=2, max_iter=2)
    assert asked["checkpointInterval"] == 1


def test_a_write_releases_its_shuffles(spark):
    key, before = session._CLEANUP, shuffles(spark)
    was = spark.conf.get(key, None)
    out = session.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    new = shuffles(spark) - before
    assert out.count() == 7 and not new
    assert spark.conf.get(key, None) == was
    with session.shuffles_released(spark), session.shuffles_released(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == was


def test_tables_are_stored_where_reading_shuffles(spark):
    plain = spark.range(10).where("id > 2")
    assert session.stored(plain, "test") is plain
    summed = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()
    copy = session.stored(summed, "test")
    assert copy is not summed and "Exchange" not in copy._jdf.queryExecution().executedPlan().toString()
    assert copy.dtypes == summed.dtypes and sorted(copy.collect()) == sorted(summed.collect())


def test_a_sweep_leaves_no_tables(spark, train):
    held = train.where("(user + item) % 4 = 0")
    points = sw.grid(spark, [2], [0.1, 0.2], [1.0])
    before, blocks = len(session._SCRATCH), set(spark.sparkContext._jsc.getPersistentRDDs())
    res = sw.run_sweep(train.repartition(2), held, points, k=5, max_iter=2)
    cv = sw.cross_validate(train, points, folds=2, k=5, max_iter=2)
    assert len(session._SCRATCH) == before and res.count() == 2 and cv.count() == 2
    left(spark, shuffles(spark))
    assert not set(spark.sparkContext._jsc.getPersistentRDDs()) - blocks


def test_factors_fold_in_through_one_shuffle(spark):
    """A row is dealt to its key's chunk before it carries a factor."""
    from reclab.operators import foldin as fi

    rows = spark.createDataFrame([(i % 7, i % 5, 1.0) for i in range(70)], "user int, item int, count double")
    factors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "id int, features array<float>")
    plan = fi._sums(rows, factors, "user", "item", "count", 1.0, True, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Join Inner, \((\w+)#", plan) == ["other", "id"]  # the last join comes first
    assert fi.fold_in(rows, factors, 0.1, chunk=4).count() == 7
