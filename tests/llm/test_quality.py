import numpy as np

from reclab.llm import common, quality

from .helpers import awkward, clashing, empty, frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = quality.query(spark, SF).where("held_out").join(
        common.documents(spark, SF, "labels"), "doc_id").collect()
    y = np.array([r["quality"] for r in got])
    s = np.array([r["score"] for r in got])
    assert np.mean((s >= 0.5) == y) > 0.95
    assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() > 0.98


def test_awkward_rows_clashes_and_empty(spark):
    rng = np.random.RandomState(0)
    w = rng.randn((1 << quality.BITS) + 1).astype(np.float32)
    rows = awkward()
    got = quality.score(clashing(spark, rows, "score", "predicted"), w).collect()
    assert len(got) == len(rows)
    bias = 1 / (1 + np.exp(-float(w[-1])))
    for r in got:
        assert 0 <= r["score_"] <= 1 and r["predicted_"] == int(r["score_"] >= 0.5)
        if not (r["text"] or "").strip():
            assert abs(r["score_"] - bias) < 1e-9
    assert quality.score(empty(spark), w).count() == 0


def test_no_labels_give_a_half(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    w = quality.train(frame(spark, awkward()), labels)
    assert not w.any()
    assert {r["score"] for r in quality.score(frame(spark, awkward()), w).collect()} == {0.5}


def test_score_is_a_sparse_dot_product(spark):
    import pyarrow as pa

    texts = ["one two two", "", "x 1 !!"]
    w = np.random.RandomState(1).randn((1 << quality.BITS) + 1)
    [(n, number, value, row)] = list(quality.features(pa.array(texts)))
    assert n == 3 and np.isclose((value[row == 0] ** 2).sum(), 1) and not (row == 1).any()
    want = 1 / (1 + np.exp(-(w[number[row == 0]] @ value[row == 0] + w[-1])))
    got = quality.score(spark.createDataFrame([(0, texts[0])], "doc_id long, text string"), w.astype(np.float32))
    assert abs(got.first()["score"] - want) < 1e-5
