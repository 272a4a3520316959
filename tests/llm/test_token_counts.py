import random

from reclab.llm import token_counts as tc

from .helpers import awkward, clashing, empty, frame


def greedy(pieces, word):
    pieces, n, at = set(pieces), 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_automaton_equals_greedy_matching():
    rng = random.Random(1)
    for _ in range(60):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        machine = tc.Automaton(pieces)
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
            assert machine.length(word) == greedy(pieces, word), (pieces, word)


def test_counts_on_awkward_rows(spark):
    pieces = tc.load_vocabulary()
    rows = awkward()
    got = tc.token_counts(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got[:]:
        words = (r["text"] or "").encode().split()
        assert r["n_words"] == len(words)
        if len(words) < 200:
            each = [greedy(pieces, b" " + w) for w in words]
            assert r["n_tokens"] == sum(each) and r["max_word_tokens"] == max(each, default=0)


def test_unknown_words_empty_table_and_clashing_names(spark, tmp_path):
    import base64

    path = tmp_path / "tiny.ranks"
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate([b" a", b"b", b"a"])))
    rows = [(1, "ab ac abab", None, None, 1)]
    r = tc.token_counts(clashing(spark, rows, "n_words", "n_tokens"), str(path)).first()
    assert r["n_words_"] == 3 and r["n_unknown_words"] == 1 and r["n_tokens_"] == 2 + 1 + 4
    assert tc.token_counts(empty(spark)).count() == 0


def test_long_words_are_not_remembered():
    class Fixed:
        def length(self, word):
            return len(word)

    memo = tc._Memo(Fixed())
    assert memo[b"a" * 5000] == 5001 and memo[b"short"] == 6
    assert list(memo) == [b"short"]
