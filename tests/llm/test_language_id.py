import random

import numpy as np
import pytest

from reclab.llm import common, language_id as li

from .helpers import awkward, clashing, empty, frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = common.documents(spark, SF)
    return li.train(docs.where(~li.held_out()))


def test_held_out_accuracy(spark, model):
    docs = common.documents(spark, SF).where(li.held_out())
    got = li.identify(docs, model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_mixture_finds_both_languages(spark, model):
    rows = common.documents(spark, SF).select("lang", "text").where("length(text) > 1500").collect()
    one = {r["lang"]: r["text"][:1400] for r in rows}
    text = one["de"] + " " + one["es"][:700]
    r = li.identify(frame(spark, [(1, text, None, None, 1)]), model).first()
    assert r["n_langs"] == 2 and r["lang_pred"] == "de" and 0.5 < r["score"] < 0.85


def test_awkward_rows_empty_table_and_clashing_names(spark, model):
    rows = awkward()
    got = li.identify(clashing(spark, rows, "lang_pred", "score"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred_"] == "und") == (not letters)
        assert 0 <= r["score_"] <= 1
    assert li.identify(empty(spark), model).count() == 0


def test_model_without_languages(spark):
    langs, logp = li.train(empty(spark))
    assert langs == []
    r = li.identify(frame(spark, [(1, "some text", "en", None, 1)]), (langs, logp)).first()
    assert (r["lang_pred"], r["score"]) == ("und", 0.0)


def test_em_equals_a_plain_loop():
    rng = np.random.RandomState(0)
    logp = np.log(rng.dirichlet(np.ones(li.BUCKETS) * 0.01, 3) + 1e-7).astype(np.float32)
    buckets = np.sort(rng.randint(0, li.BUCKETS, 300))
    uniq, n = np.unique(buckets, return_counts=True)
    p = np.exp(logp[:, uniq]).astype(float)
    share = np.ones(3) / 3
    for _ in range(li.ITERATIONS):
        joint = p * share[:, None]
        share = (joint / joint.sum(0) * n).sum(1) / n.sum()
    got, _ = li._mixture(np.exp(logp[:, uniq]), n.astype(np.float32), np.array([0]), np.zeros(len(uniq), int),
                         np.array([float(n.sum())], np.float32), np.ones((3, 1), np.float32))
    assert np.allclose(got[:, 0], share, atol=1e-3)


def test_foreign_script_is_explained_by_no_language(spark, model):
    rng = random.Random(5)
    text = " ".join("".join(chr(rng.randrange(0x3041, 0x3090)) for _ in range(5)) for _ in range(80))
    r = li.identify(frame(spark, [(1, text, None, None, 1)]), model).first()
    assert r["n_langs"] == 0 and r["lang_pred"] in model[0]


def test_the_stage_keeps_what_it_cannot_judge(spark):
    short = ["Hello world", "Good night and thanks.", "Zürich", "OK", "A.\nAll rights reserved."]
    noise = "ქართული ენა და დამწერლობა ძველია და ლამაზი, ამბობენ მეცნიერები ყოველთვის"
    docs = common.documents(spark, SF)
    rows = spark.createDataFrame([(10**6 + i, t, None, None, 1) for i, t in enumerate([*short, noise, "123", "", None])],
                                 docs.schema)
    kept = {r.doc_id - 10**6 for r in li.stage(spark, docs.unionByName(rows), SF).collect() if r.doc_id >= 10**6}
    assert kept == {0, 1, 2, 3, 4}
