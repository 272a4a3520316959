"""Packing into fixed windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into whole windows and a rest; the rest is halved
until no piece exceeds a quarter of a window, so that windows are filled by
several pieces each.  Pieces are gathered in blocks.  Within a block of k
windows every piece starts as a partial partition of one filled and k - 1 empty
parts; the two partial partitions with the largest imbalance are merged again
and again, the fullest parts of one with the emptiest of the other, until one
partition into k near-equal windows is left.  k starts at the least number of
windows that could hold the block and rises whenever a window exceeds its
capacity.

Blocks are packed where their documents are read: no exchange is needed, a
task holds one block at a time, and a re-run task gives the same windows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 2048
END = 1
#: Windows of pieces that one block gathers.
BLOCK_WINDOWS = 192
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Words whose ids a worker remembers; the set before it is kept as long again.
MEMO_WORDS = 300_000
#: And the characters and id bytes it may hold by then.
MEMO_BYTES = 64 << 20


def differencing(sizes, parts: int) -> list[list[int]]:
    """Split the items into ``parts`` lists of near-equal sums."""
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(parts, np.int64)
        sums[-1] = s
        heap.append((-int(s), i, sums, [None] * (parts - 1) + [(i,)]))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        joined = a + b[::-1]
        order = np.argsort(joined, kind="stable")
        joined = joined[order]
        flipped = in_b[::-1]
        members = []
        for j in order.tolist():
            x, y = in_a[j], flipped[j]
            members.append(x if y is None else y if x is None else (x, y))
        joined -= joined[0]  # only differences matter
        heapq.heappush(heap, (-int(joined[-1]), serial, joined, members))
        serial += 1
    if not heap:
        return [[] for _ in range(parts)]
    out = []
    for tree in heap[0][3]:
        items, stack = [], [tree]
        while stack:
            node = stack.pop()
            if node is None:
                continue
            if len(node) == 1:
                items.append(node[0])
            else:
                stack.extend((node[1], node[0]))
        out.append(items)
    return out


def pack(sizes, capacity: int = WINDOW) -> list[list[int]]:
    """Windows (lists of item numbers) of at most ``capacity`` each; every
    size must be from 1 to ``capacity``."""
    if not len(sizes):
        return []
    sizes = np.asarray(sizes, np.int64)
    parts = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        windows = differencing(sizes, parts)
        if all(sum(int(sizes[i]) for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        parts += 1


def cuts(n: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, length) pieces of ``n`` ids: whole windows, then the rest in
    equal parts of at most a quarter of a window."""
    full = n // window
    out = [(i * window, window) for i in range(full)]
    at, rest = full * window, n % window
    if rest:
        quarter = max(1, window // 4)
        parts = -(-rest // quarter)
        edges = [at + rest * j // parts for j in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:], strict=False) if b > a]
    return out


class Encoder:
    """Ids of texts by a ``tokenizers`` file, as little-endian 32-bit words.

    The byte-level split always starts a new piece at a space before a
    non-space character, so the ids of a text are those of its space-led words
    in a row; ids of words met lately are remembered (a bounded memo).  New
    words of common characters are merged by the rank file of the same
    vocabulary, many in one call: a word's ids begin where a piece begins with
    a space.  Other words, texts with other white space next to a space, and
    texts with a special token's string go through the tokenizer itself.
    """

    def __init__(self, path: str | None):
        import base64
        import json
        import os
        import re

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.merge = None
        if path is None:
            import public_tokenizers
            import tiktoken

            path = public_tokenizers.path(TOKENIZER)
            with open(public_tokenizers.path(RANKS), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.merge = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                           mergeable_ranks=ranks, special_tokens={})
            self.leads = np.zeros(max(ranks.values()) + 1, bool)
            self.leads[[r for piece, r in ranks.items() if piece.startswith(b" ")]] = True
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        pre = rules.get("pre_tokenizer") or {}
        self.by_word = (rules.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        special = [re.escape(t["content"]) for t in rules.get("added_tokens", [])]
        # a white space other than a single space beside a space, or a space at the end
        self.whole = re.compile("|".join([r" \s", r" \Z", *special]))
        # characters whose class is beyond doubt in either library
        self.rare = re.compile(r"[^\t\n\r!-~\u00a1-\u024f]")
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        batch = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in batch]

    def _learn(self, words: list[str]) -> None:
        """Put the ids of new words (without their space) into the memo."""
        if len(self.words) > MEMO_WORDS or self.held > MEMO_BYTES:
            self.words, self.older, self.held = {}, self.words, 0
        fresh = []
        for w in words:
            known = self.older.get(w)
            if known is None:
                fresh.append(w)
            else:
                self.words[w] = known
        rare = fresh if self.merge is None else [w for w in fresh if self.rare.search(w)]
        if rare:
            self.words.update(zip(rare, self._encode([" " + w for w in rare]), strict=True))
            fresh = [] if self.merge is None else [w for w in fresh if w not in self.words]
        if fresh:
            ids = np.array(self.merge.encode_ordinary(" " + " ".join(fresh)), "<u4")
            at = (np.flatnonzero(self.leads[ids]) * 4).tolist()
            raw = ids.tobytes()
            self.words.update(zip(fresh, [raw[i:j] for i, j in zip(at, [*at[1:], len(raw)], strict=True)],
                                  strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if not self.by_word or self.whole.search(t) else t.split(" ") for t in texts]
        fresh = set()
        for parts in split:
            if parts:
                fresh.update(parts[1:])
        fresh.difference_update(self.words)
        memo = self.words
        if fresh:
            before = memo
            self._learn(list(fresh))
            memo = self.words
            self.held += sum(len(w) + len(memo[w]) for w in fresh)
            if memo is not before:  # a new memo: words of this batch come along
                for parts in split:
                    if parts:
                        memo.update((w, before[w]) for w in parts[1:] if w not in memo)
        # the first word has no space before it
        whole = self._encode([t if p is None else p[0] for t, p in zip(texts, split, strict=True)])
        return [w if p is None else w + b"".join([memo[x] for x in p[1:]])
                for w, p in zip(whole, split, strict=True)]


_ENCODERS: dict[str | None, Encoder] = {}

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType())])

#: Texts tokenised at once: rows, and characters.
_GROUP, _GROUP_CHARS = 256, 1 << 20


def pack_documents(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None,
                   block_windows: int = BLOCK_WINDOWS, end: int = END) -> DataFrame:
    """Pieces of all documents (doc_id long, text): doc_id, start, length, ids
    (binary: little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its ids and then ``end``; null text counts as empty (only
    ``end``).  Repeated rows and ties are packed each for itself; a null doc_id
    stays null.  Empty table: no rows.  Extra columns are ignored.  sequence_id
    is unique (reading task and counter), not gapless; offsets in a sequence
    are gapless from 0 and in the order of its rows.
    """
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        encoder = _ENCODERS.get(tokenizer)
        if encoder is None:
            encoder = _ENCODERS[tokenizer] = Encoder(tokenizer)
        serial = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        waiting: list[tuple] = []
        held = 0

        def flush():
            nonlocal serial, waiting, held
            for members in pack([p[2] for p in waiting], window):
                at = 0
                for i in members:
                    rows.append((*waiting[i], serial, at))
                    at += waiting[i][2]
                serial += 1
            waiting, held = [], 0

        def take():
            columns = list(zip(*rows, strict=True)) or [()] * len(PIECES)
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if f.name == "ids" else pa.int64())
                 for c, f in zip(columns, PIECES, strict=True)], names=PIECES.names)

        def groups_():
            ids, texts, size = [], [], 0
            for batch in batches:
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    text = text.as_py() or ""
                    ids.append(i)
                    texts.append(text)
                    size += len(text)
                    if len(ids) >= _GROUP or size >= _GROUP_CHARS:
                        yield ids, texts
                        ids, texts, size = [], [], 0
            if ids:
                yield ids, texts

        for ids, texts in groups_():
            for doc, raw in zip(ids, encoder.encode(texts), strict=True):
                raw += last
                n = len(raw) // 4
                for start, length in cuts(n, window):
                    piece = (doc, start, length, raw[4 * start:4 * (start + length)], n)
                    if length == window:
                        rows.append((*piece, serial, 0))
                        serial += 1
                    else:
                        waiting.append(piece)
                        held += length
                        if held >= block_windows * window:
                            flush()
            if len(rows) > 1024:
                yield take()
        flush()
        yield take()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack_documents(common.documents(spark, sf_dir)))
