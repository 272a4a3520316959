"""Cross-tokenizer alignment against a plain double loop over token ends."""

import hashlib
import json
from collections import Counter

import pytest

from reclab.llm import alignment

from . import helpers

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(rows):
    """(doc_id, digest columns) of every row, by other calls than the operator's."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    file = P.path("byte_bpe_50k.json")
    byte_level = Tokenizer.from_file(file)
    byte_level.encode_special_tokens = True
    table = {}  # the usual byte alphabet, written as its defining loop
    extra = 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            table[chr(byte)] = byte
        else:
            table[chr(256 + extra)] = byte
            extra += 1
    entry = {i: p for p, i in json.load(open(file, encoding="utf-8"))["model"]["vocab"].items()}
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def spans(ids, raw):
        out, at = [], 0
        for i in ids:
            at += len(raw(i))
            out.append((i, at))
        return out

    def raw_a(i):
        return bytes(table[c] for c in entry[i])

    def raw_b(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    docs = []
    for row in rows:
        text = row[1]
        a = b = []
        if text:
            ids_a = byte_level.encode(" " + text, add_special_tokens=False).ids
            ids_b = model.encode(text)
            want = (" " + text).encode()
            if b"".join(map(raw_a, ids_a)) == want == b"".join(map(raw_b, ids_b)):
                a, b = spans(ids_a, raw_a), spans(ids_b, raw_b)
        pairs = [(x, y) for x, e in a for y, f in b if e == f] if len(a) * len(b) < 10**6 else None
        if pairs is None:
            at = {}
            for y, f in b:
                at.setdefault(f, []).append(y)
            pairs = [(x, y) for x, e in a for y in at.get(e, ())]
        ends = sorted({e for _, e in a} & {f for _, f in b})
        groups = ";".join(
            ",".join(str(x) for x, e in a if lo < e <= hi) + "|" + ",".join(str(y) for y, f in b if lo < f <= hi)
            for lo, hi in zip([0, *ends], ends, strict=False)) if len(ends) < 3000 else None
        docs.append((row[0], a, b, ends, pairs, groups))
    count = Counter(p for d in docs for p in d[4])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(doc, len(a), len(b), len(ends), len(pairs), sum(count[p] == best[p[1]] for p in pairs),
             sum(count[p] for p in pairs),
             groups and hashlib.sha256(groups.encode()).hexdigest() if groups is not None else None)
            for doc, a, b, ends, pairs, groups in docs]


def check(found, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:7])
    got = sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in found.collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:7] == w[:7]
        if w[7] is not None:  # too long for the plain grouping otherwise
            assert g[7] == w[7]
    return got


ODD = [(100, "two  spaces", None, None, 1), (101, " leads", None, None, 1), (102, "ends ", None, None, 1),
       (103, "a▁b", None, None, 1), (104, "ﬁne ½ ａｂ café", None, None, 1), (105, "\n\n\tx\r\n", None, None, 1),
       (106, "\u0000nul", None, None, 1), (107, "don't I'LL 12345 !!??", None, None, 1),
       (108, "<s> </s> <unk> <0x41> <|endoftext|>", None, None, 1), (109, "👩‍👩‍👧 🇫🇷 क्षि", None, None, 1),
       (110, "ſupérieur Ǆ ɏ ɐ", None, None, 1), (111, " ", None, None, 1)]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 20, 0])
def test_equals_brute_force(spark, limit):
    rows = helpers.awkward() + ODD
    found = alignment.corpus_alignment(helpers.frame(spark, rows), broadcast_pairs=limit)
    got = check(found, rows)
    assert sum(g[1] == 0 for g in got) >= 4  # null, empty, changed by an encoder
    assert all(g[7] == "" for g in got if g[1] == 0)


def test_steps_do_not_change_groups(spark):
    rows = [(1, "the river stone walks under green old bridges " * 50, None, None, 1)]
    whole = alignment.align(helpers.frame(spark, rows)).collect()[0]
    for step in (1, 2, 7):
        part = alignment.align(helpers.frame(spark, rows), step=step).collect()[0]
        assert (part.cuts_a, part.cuts_b) == (whole.cuts_a, whole.cuts_b)
    assert whole.cuts_a[-1] == len(whole.ids_a) and whole.cuts_b[-1] == len(whole.ids_b)


def test_tokens_without_bytes_link_with_all_that_end_there():
    import numpy as np

    ends_a, ends_b = np.array([1, 1, 3]), np.array([1, 2, 3, 3])
    for step in (1, 2, 10):
        cuts = alignment.common_cuts(ends_a, ends_b, step)
        assert cuts == ([1, 3], [2, 3], [1, 4])
        found = alignment.links([7, 8, 9], [1, 2, 3, 4], ends_a, ends_b, cuts).tolist()
        assert [(x >> 32, x & 0xFFFFFFFF) for x in found] == [(7, 1), (8, 1), (9, 3), (9, 4)]


def test_empty_table_and_clashing_columns(spark):
    assert alignment.corpus_alignment(helpers.empty(spark)).count() == 0
    rows = helpers.awkward()
    clash = helpers.clashing(spark, rows, "ids_a", "pair", "row", "n_a", "cuts_b")
    check(alignment.corpus_alignment(clash), rows)
    assert {"ids_a", "ids_a_", "cuts_b_"} <= set(alignment.align(clash).columns)


def test_query(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    check(alignment.query(spark, SF_SMALL), [tuple(r) for r in docs])
