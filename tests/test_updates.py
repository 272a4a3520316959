"""Growing dictionary, folded-in factors, paired bootstrap."""

import hashlib
import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from reclab.operators import als as A
from reclab.operators import foldin as fi
from reclab.operators import index as ix
from reclab.operators import significance as sg
from reclab.operators.dictionary import Dictionary


def labels(spark, text):
    return spark.createDataFrame([(x or None,) for x in text.split(" ")], "x string")


def mapping(d, version=None):
    return {r.label: (r.idx, r.version) for r in d.mapping(version).collect()}


def test_ids_never_move(spark, tmp_out):
    d = Dictionary(spark, f"{tmp_out}/d")
    assert d.state() == (0, -1) and mapping(d) == {}
    assert d.extend(labels(spark, "b a a c c"), "x") == 1
    assert mapping(d) == {"a": (0, 1), "c": (1, 1), "b": (2, 1)}
    assert d.extend(labels(spark, "z z z a b y  "), "x") == 2
    assert mapping(d) == {"a": (0, 1), "c": (1, 1), "b": (2, 1), "z": (3, 2), "y": (4, 2)}
    assert d.extend(labels(spark, "a z  "), "x") == 2  # nothing new: no version
    assert mapping(d, 1) == {"a": (0, 1), "c": (1, 1), "b": (2, 1)}
    applied = ix.apply_index(labels(spark, "z b"), d.mapping(), "x", "i").collect()
    assert sorted((r.x, r.i) for r in applied) == [("b", 2), ("z", 3)]
    assert d.extend(spark.createDataFrame([], "x string"), "x") == 2


def test_writers_at_the_same_time_share_no_id(spark, tmp_out):
    d = Dictionary(spark, f"{tmp_out}/d")
    batches = [" ".join(f"l{i % 7}_{j}" for j in range(5)) for i in range(9)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda b: d.extend(labels(spark, b), "x"), batches))
    rows = d.mapping().collect()
    assert len(rows) == 35 == len({r.label for r in rows})
    assert sorted(r.idx for r in rows) == list(range(35))


def plain(rows, factors, reg, alpha, implicit):
    rank = len(next(iter(factors.values())))
    gram = sum(np.outer(y, y) for y in factors.values())
    out = {}
    for u in {r[0] for r in rows}:
        a, b, n = (gram.copy() if implicit else np.zeros((rank, rank))), np.zeros(rank), 0
        for _, i, c in (r for r in rows if r[0] == u and r[1] in factors and r[2] is not None):
            y = factors[i]
            if implicit:
                a += alpha * abs(c) * np.outer(y, y)
                b += (1 + alpha * abs(c)) * y if c > 0 else 0
                n += c > 0
            else:
                a, b, n = a + np.outer(y, y), b + c * y, n + 1
        if any(r[0] == u and r[1] in factors and r[2] is not None for r in rows):
            out[u] = np.linalg.solve(a + reg * n * np.eye(rank), b)
    return out


@pytest.mark.parametrize("implicit", [True, False])
@pytest.mark.parametrize("chunk", [4096, 3])
def test_fold_in_solves_the_normal_equations(spark, implicit, chunk):
    rng = np.random.RandomState(0)
    factors = {i: rng.standard_normal(4).astype(np.float32).astype(float) for i in range(12)}
    rows = [(u, int(i), float(rng.randint(1, 6))) for u in range(5) for i in rng.choice(14, 6, replace=False)]
    rows += [(9, i, 2.0) for i in range(12)] * 5 + [(7, 99, 1.0), (6, 1, None), (3, 2, 4.0), (4, 3, -2.0), (4, 5, 0.0)]
    table = spark.createDataFrame(rows, "user int, item int, count double").withColumn("features", F.lit(1))
    side = spark.createDataFrame([(i, v.tolist()) for i, v in factors.items()], "id int, features array<float>")
    want = plain(rows, factors, 0.1, 2.0, implicit)
    folded = fi.fold_in(table, side, 0.1, 2.0, implicit, chunk=chunk)
    got = {r.id: r.features for r in folded.collect()}
    assert set(got) == set(want) and 7 not in got and 6 not in got
    for u, x in want.items():
        assert np.allclose(got[u], x, atol=1e-4)
    worst = fi.gradients(folded, table, side, 0.1, 2.0, implicit, chunk=chunk).agg(F.max("gradient")).first()[0]
    assert worst < 1e-6


def test_fold_in_equals_the_last_half_step_of_a_fit(spark):
    rng = np.random.RandomState(1)
    rows = [(u, int(i), float(rng.randint(1, 9))) for u in range(30) for i in rng.choice(20, 7, replace=False)]
    train = spark.createDataFrame(rows, "user int, item int, count double")
    for implicit in (True, False):
        model = A.fit_als(train, rank=3, max_iter=4, alpha=1.5, reg_param=0.05, implicit=implicit)
        fitted = {r.id: r.features for r in model.userFactors.collect()}
        folded = fi.fold_in(train, model.itemFactors, 0.05, 1.5, implicit)
        for r in folded.collect():
            assert np.allclose(r.features, fitted[r.id], atol=1e-3)


def test_fold_in_of_nothing(spark):
    side = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<float>")
    none = spark.createDataFrame([], "user int, item int, count double")
    assert fi.fold_in(none, side, 0.1).count() == 0


def poisson(user, replicate, seed=""):
    word = hashlib.md5(f"{seed}:{user}:{replicate // 4}".encode()).hexdigest()
    word = int(word[replicate % 4 * 8:replicate % 4 * 8 + 8], 16)
    return sum(word >= step for step in sg.STEPS)


def test_weights_are_poisson_of_one():
    w = [poisson(u, r) for u in range(300) for r in range(40)]
    for k in range(4):
        assert abs(w.count(k) / len(w) - math.exp(-1) / math.factorial(k)) < 0.01


def test_replicates_equal_a_plain_loop(spark):
    rows = [(u, float(u % 5), float(u % 3)) for u in range(60)] + [(70, None, 1.0), (71, 1.0, float("nan"))]
    pairs = spark.createDataFrame(rows, "user int, a double, b double")
    got = {r.replicate: (r.weight, r.sum_a, r.sum_b) for r in sg.replicates(pairs, 10, seed="s").collect()}
    for rep in range(10):
        w = [poisson(u, rep, "s") for u in range(60)]
        assert got[rep] == (sum(w), sum(x * (u % 5) for u, x in enumerate(w)), sum(x * (u % 3) for u, x in enumerate(w)))


def test_compare_tells_luck_from_gain(spark):
    rng = np.random.RandomState(2)
    base = rng.rand(400)
    frames = {"same": base, "better": base + 0.2 + 0.05 * rng.randn(400), "noise": base + rng.randn(400) * 0.5}
    rows = {n: sg.compare(spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(base, v))],
                                                "user int, a double, b double")).first() for n, v in frames.items()}
    assert rows["same"].p_value == 1.0 and rows["same"].mean_diff == 0
    assert rows["better"].p_value == 0.0 and 0.19 < rows["better"].diff_low < rows["better"].diff_high < 0.21
    assert rows["noise"].diff_low < rows["noise"].mean_diff < rows["noise"].diff_high
    assert rows["same"].n_users == 400 and rows["same"].n_replicates == 200


def test_fold_in_makes_no_group_call_per_key(spark):
    """Runs of sorted rows are summed and solved many at a time, over batch borders too."""
    rng = np.random.RandomState(3)
    factors = spark.createDataFrame([(i, [float(a) for a in rng.standard_normal(3)]) for i in range(9)],
                                    "id int, features array<float>")
    rows = [(u, int(i), float(rng.randint(0, 5))) for u in range(40) for i in rng.choice(9, 1 + u % 9, replace=False)]
    rows += [(99, int(i), 2.0) for i in rng.randint(0, 9, 500)]  # a heavy key
    got = fi.fold_in(spark.createDataFrame(rows, "user int, item int, count double"), factors, 0.1, chunk=7)
    assert "FlatMapGroups" not in got._jdf.queryExecution().toString()
    y = {r.id: np.array(r.features, float) for r in factors.collect()}
    gram = sum(np.outer(a, a) for a in y.values())
    found = {r.id: np.array(r.features) for r in got.collect()}
    assert found.keys() == {u for u, _, _ in rows}
    for u in found:
        own = [(y[i], r) for v, i, r in rows if v == u]
        a = gram + sum(r * np.outer(z, z) for z, r in own) + 0.1 * sum(r > 0 for _, r in own) * np.eye(3)
        assert np.allclose(found[u], np.linalg.solve(a, sum((z * (1 + r) * (r > 0) for z, r in own))), atol=1e-5)
