import hashlib
import re

from reclab.llm import exact_dedup as ed

from .helpers import awkward, clashing, empty, frame


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_chunks_join_to_the_text_and_follow_content():
    import random

    rng = random.Random(4)
    text = bytes(rng.randrange(256) for _ in range(60_000))
    assert b"".join(ed.chunks(text)) == text
    moved = ed.chunks(b"some bytes before" + text)
    assert len(set(moved) & set(ed.chunks(text))) > len(moved) // 2
    assert ed.chunks(b"") == [] and b"".join(ed.chunks(b"a" * 200_000)) == b"a" * 200_000


def brute(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), d is None, d or 0, d))
    return {k: (min(v)[3], -min(v)[0], len(v)) for k, v in groups.items()}


def test_awkward_rows(spark):
    rows = awkward()
    want = brute(rows)
    got = ed.exact_duplicates(clashing(spark, rows, "recipe", "keep_id", "text_sha256")).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    for r in got:
        keep, _, size = by_sha[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (keep, size)
    assert {r["text_sha256"] for r in got if r["kept"]} == set(by_sha)


def test_deduplicate_leaves_one_row_of_each_text(spark):
    rows = awkward()
    got = ed.deduplicate(clashing(spark, rows, "recipe", "n_points")).collect()
    want = brute(rows)
    assert sorted(norm(r["text"]) for r in got) == sorted(want)
    assert all(r["doc_id"] == want[norm(r["text"])][0] for r in got)


def test_identifiers_widen_until_chunks_are_told_apart(spark):
    rows = [(i, f"text number {i} with words", None, None, 1) for i in range(600)]
    docs = frame(spark, rows)
    assert ed.collisions(ed.chunk_table(docs, 1)) > 0
    width = ed.verified_width(docs, 1)
    assert width > 1
    assert ed.exact_duplicates(docs, 1).where("kept").count() == 600


def test_hot_group_and_empty_table(spark):
    rows = [(i, "same" + " " * (i % 3), None, None, 1) for i in range(500)]
    got = ed.exact_duplicates(frame(spark, rows)).collect()
    assert {(r["keep_id"], r["group_size"]) for r in got} == {(2, 500)}
    assert ed.exact_duplicates(empty(spark)).count() == 0
    assert ed.deduplicate(empty(spark)).count() == 0


def test_own_names_do_not_clash(spark):
    docs = clashing(spark, awkward(), "dedup_recipe", "dedup_keep_id", "_dedup_keep_rows")
    got = ed.deduplicate(docs)
    assert got.columns == docs.columns and got.count() == len(brute(awkward()))
