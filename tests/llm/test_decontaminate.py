import re

from reclab.llm import decontaminate as dc

from .helpers import awkward, clashing, empty, frame

ITEMS = [
    (0, "A train leaves with 120 passengers. At the first stop Maria lets 35 km pass, then Maria adds 12 more "
        "people to the count before the train goes on to the next town."),
    (1, "the quick brown fox jumps over the lazy dog near the quiet river bank at dawn"),
    (2, "too short item"), (3, None), (4, ""),
    (5, "the quick brown fox jumps over the lazy dog near the quiet river bank at dawn"),
]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def found(spark, *texts, **options):
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)]
    return {(r["doc_id"], r["item_id"]): r for r in dc.contaminated(
        frame(spark, rows), items(spark), **options).collect()}


def test_copies_recased_and_reparameterised(spark):
    q = ITEMS[0][1]
    other = q.replace("120", "480").replace("35", "7").replace("12 ", "99 ").replace("Maria", "Peter")
    got = found(spark, "Before. " + q + " After.", q.lower(), other, q.replace("Maria adds", "Peter adds"),
                q.replace("\n", " ").replace(" ", "\n"))
    assert (0, 0) in got and (1, 0) in got and got[0, 0]["renamed"] == 0
    assert (2, 0) in got and got[2, 0]["renamed"] >= 3
    assert (3, 0) not in got  # one name stands for two values: the slots disagree
    assert (4, 0) in got
    both = found(spark, q + " And again: " + other)
    assert both[0, 0]["renamed"] == 0  # two copies that differ, each consistent


def test_half_an_item_is_not_the_item(spark):
    words = ITEMS[1][1].split()
    got = found(spark, " ".join(words[:9]) + " something else", ITEMS[1][1].upper(), "clean text " * 20)
    assert set(got) == {(1, 1)} and got[1, 1]["n_items"] == 2


def test_shuffle_join_gives_the_same(spark):
    texts = [ITEMS[1][1], "x " + ITEMS[0][1]]
    assert set(found(spark, *texts)) == set(found(spark, *texts, broadcast_windows=0)) == {(0, 1), (1, 0)}


def test_awkward_rows_clashes_and_empty_tables(spark):
    rows = awkward() + [(200, ITEMS[1][1], None, None, 1)] * 3 + [(None, ITEMS[1][1], None, None, 1)]
    docs = clashing(spark, rows, "key_a", "tokens", "item_id")
    got = sorted(((r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, items(spark)).collect()),
                 key=lambda x: (x[0] is None, x))
    assert got == [(200, 1), (None, 1)]
    kept = dc.clean(docs, items(spark))
    assert kept.columns == docs.columns and kept.count() == len(rows) - 4
    assert dc.contaminated(empty(spark), items(spark)).count() == 0
    none = items(spark).where("false")
    assert dc.contaminated(docs, none).count() == 0 and dc.clean(docs, none).count() == len(rows)


def test_equals_plain_search_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    from reclab.llm import common

    docs, bench = common.documents(spark, sf), common.documents(spark, sf, "benchmark")

    def plain(t):
        return " " + " ".join(re.findall(r"[^\W\d_]+|\d+", (t or "").lower())) + " "

    want = {(d["doc_id"], b["item_id"]) for d in docs.collect() for b in bench.collect()
            if plain(b["text"]) in plain(d["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in dc.query(spark, sf).collect()}
    assert want and want == got


def test_plan_is_native(spark):
    plan = dc.contaminated(frame(spark, awkward()), items(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


OPENING = ("Alice has 12 apples and 5 pears. Bob gives her 7 more apples. How many apples does she have now?",
           "Helen has 31 apples and 9 pears. Peter gives her 4 more apples. How many apples does she have now?")


def contained(spark, item, *texts):
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)]
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    return {r["doc_id"]: r for r in dc.contaminated(frame(spark, rows), bench).collect()}


def test_names_that_open_sentences_are_slots(spark):
    item, other = OPENING
    got = contained(spark, item, other, "Well, " + other, other.replace(". ", ".\n"), other.replace("Peter", '"Peter"'),
                    other.replace("Helen has", "Alice has").replace("Peter", "Alice"))
    assert set(got) == {0, 1, 2, 3}  # of one name for two the slots disagree
    assert got[0]["n_matched"] == got[0]["n_windows"] == 13 and got[0]["renamed"] == 5


def test_an_opening_word_that_changed_does_not_reject_a_copy(spark):
    item = "Then " + ITEMS[1][1] + ". Then all of them went home to sleep until the next morning came along."
    got = contained(spark, item, item.replace(". Then", ". Now"), "One Two Three Four Five Six Seven Eight Nine Ten. " * 9)
    assert set(got) == {0}


def test_numbers_are_free_and_one_altered_unit_does_not_reject(spark):
    item, other = OPENING
    pays = "a man buys 3 apples for 3 dollars and then walks home with all of them in a bag"
    got = contained(spark, item, other.replace("31", "6").replace("9 pears", "6 pears"), item.replace("7", "12"))
    assert set(got) == {0, 1}
    assert set(contained(spark, pays, pays.replace("3 apples for 3", "4 apples for 5"))) == {0}
    runs = " ".join(["she runs 3 miles on the first of the days before noon,", "then after a long rest in the shade and a "
                     "glass of water she runs 5 miles more and goes home to sleep until the next morning comes along"])
    assert set(contained(spark, runs, runs.replace("5 miles", "5 km"))) == {0}


def test_numbers_alone_are_no_question(spark):
    row = "1 2 3 4 5 6 7 8 9 10 11 12"
    got = contained(spark, row, row, "21 22 23 24 25 26 27 28 29 30 31 32", "7 7 7 7 7 7 7 7 7 7 7 7")
    assert set(got) == {0}
