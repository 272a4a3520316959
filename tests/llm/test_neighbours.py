"""Learned partitions against brute force: exact with one part, recall with many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reclab.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=10):
    good = sorted({(i, tuple(np.float32(v).tolist())) for i, v in rows
                   if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    sizes = {}
    for _, v in good:
        sizes[len(v)] = sizes.get(len(v), 0) + 1
    size = min(sizes, key=lambda s: (-sizes[s], s), default=0)
    good = [(i, v) for i, v in good if len(v) == size]
    asked = {}
    for i, v in good:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in sorted(asked.items()):
        near = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), i) for i, w in good if i != q)
        out += [(q, r, i, d) for r, (d, i) in enumerate(near[:k], 1)]
    return out


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(partitions)


def run(spark, rows, **kw):
    found = neighbours.search(table(spark, rows), F.col("vec_id") % 100 == 0, **kw)
    return sorted(tuple(r) for r in found.collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=1e-12)


def vectors(n, dim=8, seed=0, groups=None):
    rng = np.random.RandomState(seed)
    x = rng.standard_normal((n, dim))
    if groups:
        x = x * 0.2 + rng.standard_normal((groups, dim))[rng.randint(groups, size=n)] * 3
    return [(i, x[i].astype(np.float32).tolist()) for i in range(n)]


def test_one_part_is_exact_on_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(300) + [(None, [1.0] * 8), (1000, None), (1100, [0.0] * 8), (1200, [nan] + [1.0] * 7),
                           (1300, [inf] + [1.0] * 7), (1400, [None] + [1.0] * 7), (1500, []), (1600, [1.0, 2.0]),
                           (1700, [-0.0] * 8), (-100, [0.5] * 8), (5, [0.5] * 8), (5, [0.25] * 8),
                           (200, [0.5] * 8), (100, vectors(300)[100][1])]
    rows += [(i, vectors(300)[7][1]) for i in range(2000, 2200)] + [(2000, vectors(300)[7][1])] * 3  # a hot vector
    same(run(spark, rows, parts=1), brute(rows))
    same(run(spark, rows, parts=1, k=3), brute(rows, k=3))


def test_few_candidates_and_empty_table(spark):
    rows = vectors(4)
    same(run(spark, rows), brute(rows))
    assert len(run(spark, rows)) == 3
    assert run(spark, [(0, [1.0, 2.0])]) == []
    assert run(spark, []) == []


def test_blocks_change_nothing(spark, monkeypatch):
    rows = vectors(1500, seed=3) + [(i, [0.1] * 8) for i in range(3000, 3400)]
    want = run(spark, rows, parts=4, sample_rows=400)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    assert run(spark, rows, parts=4, sample_rows=400) == want


@pytest.mark.parametrize("groups", [None, 12])
def test_recall(spark, groups):
    rows = vectors(4000, dim=16, seed=5, groups=groups)
    got, want = run(spark, rows, sample_rows=1500), brute(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)
    real = {(w[0], w[2]): w[3] for w in want}
    assert all(abs(real[g[0], g[2]] - g[3]) < 1e-9 for g in got if (g[0], g[2]) in real)


def test_structure_saves_probes(spark):
    x = np.array([v for _, v in vectors(2000, dim=16, seed=6, groups=16)])
    fitted = neighbours.Partitions(spark, x, 16)
    i, _ = fitted.router.probes(x, fitted.share)
    assert len(i) <= 0.35 * 16 * len(x)  # of 16 parts a query opens a third at most


def test_parts_are_balanced_and_cut_few_edges(spark):
    x = np.array([v for _, v in vectors(900, dim=8, seed=7, groups=6)])
    graph, _ = neighbours.nearest(x, x, 10, own=np.arange(len(x)))
    start = neighbours.balanced_parts(graph, x, 7, rounds=0)
    part = neighbours.balanced_parts(graph, x, 7)
    sizes = np.bincount(part, minlength=7)
    assert sizes.max() <= np.ceil(1.1 * 900 / 7)
    cut = [(p[:, None] != p[graph]).mean() for p in (start, part)]
    assert cut[1] < cut[0]


def test_query_has_recall_of_nine_tenths(spark):
    from tests.conftest import SF_MID

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    want = brute(rows)
    got = neighbours.query(spark, SF_MID).collect()
    assert len(got) == len(want)
    assert len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)


def test_clashing_columns(spark):
    rows = vectors(300)
    clash = table(spark, rows)
    for name in ("v", "h", "q", "part", "query_id", "score", "rank"):
        clash = clash.withColumn(name, F.lit(1))
    found = neighbours.search(clash, F.col("vec_id") % 100 == 0, parts=1)
    same(sorted(tuple(r) for r in found.collect()), brute(rows))
