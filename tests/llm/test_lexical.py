"""Ranked lexical search against a plain loop over all documents, and its SQL."""

import math
import random
import re
from collections import Counter

import pytest

from reclab.llm import lexical

from . import helpers

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    small = re.sub("[A-Z]", lambda c: chr(ord(c[0]) + 32), text or "")
    return PATTERN.findall(small)


def brute(docs, items, k=20):
    bags = [(d, Counter(words(t))) for d, t in docs]
    lengths = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        found = []
        for (doc, bag), n in zip(bags, lengths, strict=True):
            if doc is None or not n:
                continue
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * ((10**9 * bag[w]) // (1000 * bag[w] + 12 * m)) for w in words(text) if w in bag)
            if score > 0:
                found.append((-score, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def run(spark, docs, items, **kw):
    table = spark.createDataFrame(items, ITEMS)
    return sorted(tuple(r) for r in lexical.rank(docs, table, **kw).collect())


QUESTIONS = [(1, "The RIVER, the river; stone?"), (2, None), (3, ""), (4, "!!! ..."), (5, "unknownword 日本語 テキスト"),
             (6, "word"), (7, "w21 w22 bread"), (8, "123 a_b"), (9, "aaaaaaaa" * 60), (10, "no id at all here")]


def test_equals_brute_force(spark):
    rows = helpers.awkward()
    docs = [(r[0], r[1]) for r in rows]
    assert run(spark, helpers.frame(spark, rows), QUESTIONS) == brute(docs, QUESTIONS)
    for k in (1, 3):
        assert run(spark, helpers.frame(spark, rows), QUESTIONS, k=k) == brute(docs, QUESTIONS, k)


def test_classes_expand_by_id_and_ties_interleave(spark):
    # one class holds most documents; classes with equal scores interleave by id
    rng = random.Random(5)
    docs = [(i, "alpha beta x%d" % (i % 3), None, None, 0) for i in range(300)]
    docs += [(1000 + i, rng.choice(["beta alpha y", "alpha gamma", "gamma", ""]), None, None, 0) for i in range(100)]
    rng.shuffle(docs)
    items = [(1, "alpha"), (2, "gamma alpha alpha"), (3, "y"), (4, "beta gamma")]
    found = run(spark, helpers.frame(spark, docs, 7), items)
    assert found == brute([(d[0], d[1]) for d in docs], items)
    assert [r[2] for r in found if r[0] == 1][:5] == sorted(r[2] for r in found if r[0] == 1)[:5]


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    rows = helpers.awkward(3)
    want = brute([(r[0], r[1]) for r in rows], QUESTIONS)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 4)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 5)
    assert run(spark, helpers.frame(spark, rows), QUESTIONS) == want


def test_long_items_leave_the_exact_doubles(spark):
    # weights times repeats beyond 2^53 are summed in 64-bit integers
    rows = helpers.awkward()
    items = [(1, "river " * 1_000_000 + "stone " * 999_999), (2, "lamps")]
    docs = [(r[0], r[1]) for r in rows]
    items_small = [(1, "river stone"), (2, "lamps")]
    found = run(spark, helpers.frame(spark, rows), items)
    assert [r for r in found if r[0] == 2] == [r for r in brute(docs, items_small) if r[0] == 2]
    bags = [(d, Counter(words(t))) for d, t in docs]
    n = [sum(b.values()) for _, b in bags]
    nd, nt = sum(x > 0 for x in n), sum(n)
    df = Counter(w for _, b in bags for w in b)

    def gain(i, w):
        tf, m = bags[i][1][w], 75 + (25 * n[i] * nd) // nt
        return tf and math.floor(1000 * math.log((2 * nd + 2) / (2 * df[w] + 1))) * (10**9 * tf // (1000 * tf + 12 * m))

    want = sorted((-(10**6 * gain(i, "river") + 999_999 * gain(i, "stone")), d)
                  for i, (d, _) in enumerate(bags) if d is not None)
    assert [(-r[3], r[2]) for r in found if r[0] == 1] == [x for x in want if x[0] < 0][:20]


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, helpers.empty(spark), QUESTIONS) == []
    assert lexical.rank(helpers.frame(spark, helpers.awkward()), spark.createDataFrame([], ITEMS)).count() == 0
    rows = helpers.awkward()
    clash = helpers.clashing(spark, rows, "n", "bag", "row", "m", "cls", "score", "item_id")
    assert run(spark, clash, QUESTIONS) == brute([(r[0], r[1]) for r in rows], QUESTIONS)


def test_repeated_and_null_items(spark):
    rows = helpers.awkward()
    items = [(1, "stone"), (1, "river"), (1, "stone"), (None, "river"), (2, None), (2, "bread")]
    assert run(spark, helpers.frame(spark, rows), items) == brute(
        [(r[0], r[1]) for r in rows], [(1, "river"), (2, None)])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cols = "item_id, rank, doc_id, score"
    want = con.execute(f"SELECT {cols} FROM ({lexical.ORACLE_SQL}) ORDER BY 1, 2").fetchall()
    got = sorted(tuple(r) for r in lexical.query(spark, sf).select(*cols.split(", ")).collect())
    assert got == want and len(got) > 100
