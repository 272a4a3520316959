"""Token counts by a linear longest-match automaton.

The vocabulary becomes a byte trie.  Every node carries a failure link and the
number of pieces that greedy longest-match emits ("pops") when that link is
followed, both computed once in breadth-first order.  Scanning a word then
costs one transition or one link per byte, whatever the piece lengths, and the
greedy word-piece length falls out as a sum of popped counts: no piece is ever
built, and nothing is scanned twice.

Words are the maximal runs of bytes other than [\\x20\\x09-\\x0D], each read
with a leading space as the vocabulary's word-start mark.  A word with a byte
that no piece can cover counts as one unknown token.
"""

from __future__ import annotations

import base64
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import common

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Word lengths remembered by a worker before it forgets them all (memory bound).
MEMO_WORDS = 400_000
#: Longer words are counted anew each time.
MEMO_BYTES = 64


def load_vocabulary(path: str | None = None) -> list[bytes]:
    """Pieces of a rank file (base64 piece and rank on each line)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """Trie, failure links and popped counts of a vocabulary."""

    def __init__(self, pieces):
        self.go: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                nxt = self.go[node].get(byte)
                if nxt is None:
                    nxt = self.go[node][byte] = len(self.go)
                    self.go.append({})
                    final.append(False)
                node = nxt
            if node:
                final[node] = True
        # link[v]: the node reached once the pieces that v is known to begin with
        # are popped; -1 where no piece can be popped.  popped[v]: how many.
        self.link = [-1] * len(self.go)
        self.popped = [0] * len(self.go)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in self.go[parent].items():
                queue.append(node)
                if final[node]:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                back, count = self.link[parent], self.popped[parent]
                while back >= 0 and byte not in self.go[back]:
                    count += self.popped[back]
                    back = self.link[back]
                if back >= 0:
                    self.link[node], self.popped[node] = self.go[back][byte], count

    def length(self, word: bytes) -> int:
        """Greedy longest-match pieces of ``word``; -1 if it cannot be covered."""
        go, link, popped = self.go, self.link, self.popped
        node = total = 0
        for byte in word:
            nxt = go[node].get(byte)
            while nxt is None:
                if link[node] < 0:
                    return -1
                total += popped[node]
                node = link[node]
                nxt = go[node].get(byte)
            node = nxt
        while node:
            if link[node] < 0:
                return -1
            total += popped[node]
            node = link[node]
        return total


class _Memo(dict):
    def __init__(self, automaton):
        self.automaton = automaton

    def __missing__(self, word):
        n = self.automaton.length(b" " + word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = n
        return n


_MEMOS: dict[str | None, _Memo] = {}


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with n_words, n_tokens, n_unknown_words and max_word_tokens
    (long) added; names already taken get an underscore.

    Null or empty text: all 0.  Each row is counted by itself, so order, ties
    and repeated rows do not matter.  Texts and words of any length are counted
    whole, in time linear in their bytes.  ``vocabulary``: path of a rank file that
    every executor can read (default: the public byte-level one).
    """
    def make(array):
        memo = _MEMOS.get(vocabulary)
        if memo is None:
            memo = _MEMOS[vocabulary] = _Memo(Automaton(load_vocabulary(vocabulary)))
        rows = []
        for value in array.cast(pa.large_binary()):
            raw = value.as_buffer()
            words = raw.to_pybytes().split() if raw is not None else ()
            if not words:
                rows.append((0, 0, 0, 0))
                continue
            lengths = [memo[w] for w in words]
            unknown = lengths.count(-1)
            rows.append((len(words), sum(lengths) + 2 * unknown, unknown,
                         max(max(lengths), 1 if unknown else 0)))
        return [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]

    names = [common.free_name(docs, n)
             for n in ("n_words", "n_tokens", "n_unknown_words", "max_word_tokens")]
    return common.append_columns(docs, make, [(n, T.LongType()) for n in names])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(common.documents(spark, sf_dir).select("doc_id", "text"))
    return counted.drop("text")
