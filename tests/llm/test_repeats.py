import hashlib
import random

import pytest

from reclab.llm import repeats

from .helpers import awkward, clashing, empty, frame


def brute(rows, match=100):
    """By doc_id: (bytes, removed, spans, digest); documents in doc_id order."""
    seen, out = {}, {}
    rows = sorted(((d is None, d or 0, (t or "").encode()) for d, t, *_ in rows))
    for z, d, raw in rows:
        for p in range(len(raw) - match + 1):
            key = raw[p:p + match]
            if key not in seen or seen[key] > (z, d, p):
                seen[key] = (z, d, p)
    for z, d, raw in rows:
        gone = bytearray(len(raw))
        for p in range(len(raw) - match + 1):
            if seen[raw[p:p + match]] != (z, d, p):
                gone[p:p + match] = b"\1" * match
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[(d if not z else None, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())] = 1
    return set(out)


def got(df):
    return {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_awkward_rows(spark):
    rows = awkward()
    df = repeats.remove_repeats(clashing(spark, rows, "key", "spans", "start"))
    assert got(df) == brute(rows) and df.count() == len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_repetitive_corpora(spark, seed):
    rng = random.Random(seed)
    alphabet = "ab" if seed == 0 else "abcdefgh é"
    blocks = ["".join(rng.choice(alphabet) for _ in range(rng.randint(20, 400))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(blocks)[rng.randint(0, 30):] for _ in range(rng.randint(1, 6))), None, None, 1)
            for i in range(60)]
    assert got(repeats.remove_repeats(frame(spark, rows, 5))) == brute(rows)


def test_small_steps_and_one_hot_passage(spark, monkeypatch):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(300))
    rows = [(i, "".join(rng.choice("klmnop ") for _ in range(rng.randint(0, 200))) + passage
             + "".join(rng.choice("qrstuv ") for _ in range(rng.randint(0, 200))), None, None, 1) for i in range(80)]
    assert got(repeats.remove_repeats(frame(spark, rows, 7))) == brute(rows)


def test_kept_bytes_and_empty_table(spark):
    rows = [(1, "x" * 99, None, None, 1), (2, "y" * 150, None, None, 1), (3, "y" * 150, None, None, 1)]
    kept = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert kept == {1: b"x" * 99, 2: b"", 3: b""} or kept[1] == b"x" * 99
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_phrases_cover_every_start_once():
    import numpy as np

    rng = np.random.RandomState(0)
    texts = [bytes(rng.randint(97, 100, n).astype(np.uint8)) for n in (0, 99, 100, 101, 500, 3000)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    doc, start, n, *_ = repeats.phrases(data, offsets)
    for k, t in enumerate(texts):
        covered = [p for s, c in zip(start[doc == k], n[doc == k], strict=True) for p in range(s, s + c)]
        assert covered == list(range(max(0, len(t) - 99)))
