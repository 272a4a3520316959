"""Streamed top-k: equal to brute force with ties, roundings and skipped pairs;
model lists without a cross join of blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reclab.operators import als as A
from reclab.operators import topk as T


def frame(spark, x):
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>")


def queries(df):
    return df.select(F.col("id").alias("qid"), F.col("v").alias("q"))


@pytest.fixture(scope="module")
def data():
    x = np.random.RandomState(0).randint(-3, 4, size=(600, 5)).astype(float)
    x[100:140] = x[5]  # equal vectors: ties go to smaller ids
    return x


@pytest.mark.parametrize("k, digits, own", [(3, None, True), (40, 0, False), (1000, None, True)])
def test_equals_brute_force(spark, data, monkeypatch, k, digits, own):
    monkeypatch.setattr(T, "MAX_CHUNK", 64)  # several chunks
    q = data[:150]
    got = {r.qid: (list(r.ids), list(r.scores)) for r in T.streamed_topk(
        queries(frame(spark, q)), frame(spark, data), k, 5, digits, own).collect()}
    assert len(got) == len(q)
    for i, a in enumerate(q):
        s = data @ a
        want = [j for j in np.lexsort((np.arange(len(s)), -s)) if not (own and i == j)][:k]
        assert got[i][0] == want and got[i][1] == [s[j] for j in want]


def test_skipped_pairs_are_not_found(spark, data):
    rng, q = np.random.RandomState(1), data[:30]
    # one query may find almost nothing, some lose a few, others nothing
    gone = {i: set(rng.choice(600, 597 if i == 4 else 50, replace=False).tolist()) for i in range(0, 30, 2)}
    skip = spark.createDataFrame([(i, j) for i, s in gone.items() for j in s], "qid long, id long")
    got = {r.qid: list(r.ids) for r in T.streamed_topk(
        queries(frame(spark, q)), frame(spark, data), 10, 5, skip=skip).collect()}
    for i, a in enumerate(q):
        s = data @ a
        assert got[i] == [j for j in np.lexsort((np.arange(600), -s)) if j not in gone.get(i, ())][:10]


def test_model_lists_need_no_cross_join(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(20) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user int, item int, count double")
    model = A.fit_als(train, rank=3, max_iter=2)
    for recs, key, value in ((A.recommend_users(model, 7), "user", "item"), (A.recommend_items(model, 7), "item", "user")):
        plan = recs._jdf.queryExecution().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert recs.schema.simpleString() == f"struct<{key}:int,recommendations:array<struct<{value}:int,rating:float>>>"
    theirs = {r.user: {x.item: x.rating for x in r.recommendations} for r in model.recommendForAllUsers(7).collect()}
    ours = {r.user: {x.item: x.rating for x in r.recommendations} for r in A.recommend_users(model, 7).collect()}
    assert ours.keys() == theirs.keys()
    for u in ours:
        assert sorted(ours[u].values()) == pytest.approx(sorted(theirs[u].values()), abs=1e-5)


def test_unseen_lists_skip_in_place(spark):
    rows = [(u, i, 1.0) for u in range(6) for i in range(8) if i <= u]
    train = spark.createDataFrame(rows, "user int, item int, count double")
    model = A.fit_als(train, rank=2, max_iter=2)
    recs = A.recommend_unseen(model, 4, train, train)
    assert "Cartesian" not in recs._jdf.queryExecution().toString()
    got = {}
    for r in recs.collect():
        got.setdefault(r.user, []).append((r.pos, r.item))
    assert sorted(got) == [0, 1, 2, 3, 4] and len(got[0]) == 4  # user 5 has seen everything
    for u in range(1, 5):
        assert {i for _, i in got[u]} == set(range(u + 1, 6))
    assert all(sorted(p for p, _ in v) == list(range(len(v))) for v in got.values())



def test_search_sends_a_query_once_per_pass(spark):
    """What the passes of the exact search write does not grow with the clusters visited."""
    from reclab.operators import search as S

    x = np.random.RandomState(2).standard_normal((400, 4))
    items = frame(spark, x)
    part = S.fit_partitions(items, n_clusters=40)
    found = S.mips_partition(items, part, 3, probes=40, exclude_self=True)
    assert "FlatMapCoGroups" not in found._jdf.queryExecution().toString()  # one row per (query, cluster) went into those
    sent = T.cells(S._queries(items).select(F.lit("0").alias("key"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("label"),
                                            F.col("qid").alias("id"), F.col("q").alias("v"),
                                            F.array().cast("array<double>").alias("aux")))
    assert sent.agg(F.sum(F.length("ids"))).first()[0] == 8 * 400
    exact = S.mips_exact(items, part, 3, exclude_self=True, digits=1)
    want = set()
    for i, s in enumerate(T.rounded(x @ x.T, 1)):
        want |= {(i, j) for j in [j for j in np.lexsort((np.arange(400), -s)) if j != i][:3]}
    assert {(r.qid, r.id) for r in exact.collect()} == want


def test_many_chunks_run_in_waves(spark, data, monkeypatch):
    """The items go to the chunks of one wave at a time, whatever the number of chunks."""
    cores, sent = spark.sparkContext.defaultParallelism, []
    real = T.search_sorted

    def counted(rows, *a, **options):
        sent.append(rows.rdd.getNumPartitions())
        return real(rows, *a, **options)

    monkeypatch.setattr(T, "search_sorted", counted)
    monkeypatch.setattr(T, "n_chunks", lambda queries, rows: 5 * cores)
    gone = {i: set(range(0, 600, 2 + i % 3)) for i in range(0, 150, 7)}
    skip = spark.createDataFrame([(i, j) for i, s in gone.items() for j in s], "qid long, id long")
    for digits in (None, 0):
        del sent[:]
        got = {r.qid: (list(r.ids), list(r.scores)) for r in T.streamed_topk(
            queries(frame(spark, data[:150])), frame(spark, data), 9, 5, digits, skip=skip).collect()}
        assert sent == [2 * cores, 2 * cores, cores] and len(got) == 150
        for i, a in enumerate(data[:150]):
            s = data @ a
            want = [j for j in np.lexsort((np.arange(len(s)), -s)) if j not in gone.get(i, ())][:9]
            assert got[i] == (want, [s[j] for j in want])


@pytest.mark.parametrize("dtype, digits", [("f4", None), ("f8", None), ("f8", 1)])
def test_short_items_are_passed_over(dtype, digits):
    """Tiles of items too short for any list are not scored; nothing is lost."""
    rng = np.random.RandomState(3)
    x = (rng.standard_normal((4096, 6)) * np.exp(rng.standard_normal((4096, 1)))).astype(dtype)
    x = x[np.argsort(-(x * x).sum(axis=1))]
    q = rng.standard_normal((64, 6)).astype(dtype)
    ids, scored = np.arange(len(x)), []
    chunk = T.Chunk(np.arange(64), q, np.empty((64, 0)), 5, digits, False)
    real = chunk._tile
    chunk._tile = lambda part, *a: (scored.append(len(part)), real(part, *a))[1]
    for lo in range(0, len(x), 256):
        chunk.meet(np.arange(64), ids[lo:lo + 256], x[lo:lo + 256])
    assert sum(scored) < 64 * 16 / 3
    found = next(chunk.result())
    for i, a in enumerate(q):
        s = T.rounded(x @ a, digits)
        assert found.column(1)[i].as_py() == [int(j) for j in np.lexsort((ids, -s))[:5]]


def test_a_run_of_cells_is_unpacked_in_parts():
    """A task holds a bounded part of a batch of cells besides the batch."""
    import pyarrow as pa

    n = 3 * T.RUN_CELLS + 5
    one = np.arange(2, dtype=np.int64).tobytes()
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["0"] * n), pa.array([2] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([one] * n, pa.binary()),
         pa.array([one] * n, pa.binary()), pa.array([b""] * n, pa.binary())], names=["key", "kind", "label", "ids", "vals", "aux"])
    got = list(T.runs([batch]))
    assert [len(g[2]) for g in got] == [2 * T.RUN_CELLS] * 3 + [10]
    assert np.concatenate([g[2] for g in got]).tolist() == [i for i in range(n) for _ in range(2)]


def test_marked_items_come_with_their_places(spark, data, monkeypatch):
    """Only marked items of a list leave its task; pairs of repeated query ids count in all their rows."""
    rng, q = np.random.RandomState(6), data[:40]
    want = {i: set(rng.choice(600, 80, replace=False).tolist()) for i in range(0, 40, 2)}
    mark = spark.createDataFrame([(i, j) for i, s in want.items() for j in s] + [(999, 1)], "qid long, id long")
    gone = spark.createDataFrame([(2, j) for j in range(300)], "qid long, id long")
    twice = queries(frame(spark, q)).unionByName(queries(frame(spark, q)).where("qid = 4"))
    for chunks in (1, 5 * spark.sparkContext.defaultParallelism):
        monkeypatch.setattr(T, "n_chunks", lambda queries, rows: chunks)
        got = T.streamed_topk(twice, frame(spark, data), 60, 5, skip=gone, mark=mark).collect()
        assert len(got) == 41
        for r in got:
            s = data @ q[r.qid]
            best = [j for j in np.lexsort((np.arange(600), -s)) if not (r.qid == 2 and j < 300)][:60]
            assert list(zip(r.ids, r.places)) == [(j, p) for p, j in enumerate(best) if j in want.get(r.qid, ())]


@pytest.mark.parametrize("with_seen", [False, True])
def test_metrics_of_hits_are_those_of_the_lists(spark, with_seen):
    from reclab.operators import labels as lb
    from reclab.operators import metrics as mt
    from reclab.plans.evaluate import evaluate_model

    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(14) for i in range(20) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user int, item int, count double")
    held = spark.createDataFrame([(u, (u * 7 + j) % 22, 1.0) for u in range(16) for j in range(4)] + [(3, 21, 2.0), (3, 21, 2.0)],
                                 "user int, item int, count double")
    model = A.fit_als(train, rank=3, max_iter=2)
    seen = train if with_seen else None
    lists = A.recommend_unseen(model, 6, held, train) if with_seen else A.to_long(A.recommend_users(model, 6, held))
    for how in ("full", "top_tied"):
        lab = lb.labels(held, how)
        want = mt.ranking_metrics(lists.select("user", "pos", "item"), lab, ks=(3, 6)).first()
        got = evaluate_model(model, held, k=6, ks=(3, 6), labels_how=how, seen=seen).first()
        assert got.asDict() == want.asDict() and got["n_users_cold"] == 2
    hits = A.recommended_hits(model, 6, lb.labels(held), seen)
    assert hits.count() == lists.join(held.select("user", "item").distinct(), ["user", "item"]).count()
