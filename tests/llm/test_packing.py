import random
import zlib

import numpy as np

from reclab.llm import packing

from .helpers import awkward, empty, frame


def test_differencing_is_near_equal_and_complete():
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(1, 512) for _ in range(rng.randint(1, 400))]
        windows = packing.pack(sizes)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= 2048 for w in windows)
        assert len(windows) <= -(-sum(sizes) // 2048) + 1


def test_count_of_windows_rises_with_capacity():
    assert len(packing.pack([1500, 1500, 1000], 2048)) == 3
    assert packing.pack([], 2048) == []
    assert packing.pack([2048], 2048) == [[0]]


def test_cuts_cover_each_id_once():
    for n in [1, 2, 511, 512, 513, 2047, 2048, 2049, 5000, 4096]:
        pieces = packing.cuts(n)
        assert [s for s, _ in pieces] == list(np.cumsum([0] + [k for _, k in pieces])[:-1])
        assert sum(k for _, k in pieces) == n and all(0 < k <= 2048 for _, k in pieces)


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def test_round_trip_of_awkward_rows(spark):
    rows = awkward()
    t = tokenizer()
    pieces = packing.pack_documents(frame(spark, rows)).collect()
    want, have = [], {}
    for r in rows:
        want.append((r[0], tuple(t.encode(r[1] or "", add_special_tokens=False).ids) + (1,)))
    for p in pieces:
        assert p["length"] == len(p["ids"]) // 4
        have.setdefault(p["doc_id"], []).append(p)
    unique = {d: ids for d, ids in want if d is not None and [w[0] for w in want].count(d) == 1}
    for d, ids in unique.items():
        own = sorted(have[d], key=lambda p: p["start"])
        got = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in own])
        assert tuple(got) == ids and all(p["doc_tokens"] == len(ids) for p in own)
    assert sum(p["length"] for p in pieces) == sum(len(i) for _, i in want)
    by = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append(p)
    for own in by.values():
        own.sort(key=lambda p: p["offset"])
        assert sum(p["length"] for p in own) <= 2048
        assert [p["offset"] for p in own] == list(np.cumsum([0] + [p["length"] for p in own])[:-1])


def test_digest_and_empty_table(spark):
    p = packing.pack_documents(frame(spark, [(5, "a b", None, None, 1)]))
    ids = p.first()["ids"]
    assert packing.digests(p).first()["ids_crc32"] == zlib.crc32(ids)
    assert packing.pack_documents(empty(spark)).count() == 0


def test_fast_words_equal_the_tokenizer():
    rng = random.Random(3)
    alphabet = "abc  \t\n.,'s!?é ñ ­²½ ß中x12<|"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    e = packing.Encoder(None)
    old, packing.MEMO_WORDS = packing.MEMO_WORDS, 50  # forget often
    try:
        got = [x for i in range(0, 400, 16) for x in e.encode(texts[i:i + 16])]
    finally:
        packing.MEMO_WORDS = old
    assert got == e._encode(texts)


def test_memo_is_bounded_by_bytes(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "MEMO_BYTES", 2000)
    path = public_tokenizers.path(packing.TOKENIZER)
    memo, plain = packing.Encoder(path), tokenizer()
    for i in range(30):
        texts = [f"start {'x' * 400}{i} end{i}"]
        assert memo.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert sum(len(w) for w in memo.words) + sum(len(w) for w in memo.older) < 8000
