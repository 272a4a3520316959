"""Alignment of two tokenizers' ids over the same text.

Every text is encoded twice: as space + text by a byte-level vocabulary (A),
and as it is by a piece vocabulary that puts the space itself (B).  Each
encoding becomes a dictionary from cumulative byte end to token index; the
intersection of the two key sets, sorted, are the places where a token of A
and a token of B end together, and slices both id lists into groups.  Links
are expanded per slice: every A token with every B token that ends at its key.

A text's dictionaries are built for ``STEP`` tokens of A at a time, so a very
long text costs no more memory than its ids.  Both vocabularies start a new
token at a single space before a word, so every such word's end is a common
key: words of common characters are aligned once, many in one text, and their
slices are remembered (a memo bounded in words and in bytes of a word).
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import os
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BYTE_LEVEL, RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Tokens of A whose ends are in a dictionary at once.
STEP = 1 << 16
#: Bytes of text encoded in one call.
_GROUP_BYTES = 1 << 19
#: Aligned words that a worker remembers, and the longest such word (characters).
MEMO_WORDS, MEMO_CHARS = 200_000, 64
#: Id pairs whose counts are broadcast (17 bytes each); counts of rarer pairs
#: are joined by a shuffle.
BROADCAST_PAIRS = 1 << 20

_INTS = T.ArrayType(T.IntegerType())


class Tokenizers:
    """Both encoders, and the bytes of every id."""

    def __init__(self, byte_level: str | None = None, pieces: str | None = None):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.ranks = None
        if byte_level is None:
            byte_level = public_tokenizers.path(BYTE_LEVEL)
            with open(public_tokenizers.path(RANKS), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                           mergeable_ranks=ranks, special_tokens={})
        self.tokenizer = Tokenizer.from_file(byte_level)
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        # characters whose class is beyond doubt in either library
        self.rare = re.compile(r"[^\t\n\r -~¡-ɏ]")
        # words of these, each after a single space
        self.plain = re.compile(r"(?!\s)[\t\n\r!-~¡-ɏ]+(?: (?!\s)[\t\n\r!-~¡-ɏ]+)*+")
        self.words: dict[str, tuple | None] = {}
        with open(byte_level, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letters = _byte_letters()
        self.bytes_a = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for piece, i in vocabulary.items():
            # an entry with a letter of no byte (a special string) is its own UTF-8
            known = all(c in letters for c in piece)
            self.bytes_a[i] = bytes(letters[c] for c in piece) if known else piece.encode()
        self.pieces = sentencepiece.SentencePieceProcessor(
            model_file=pieces or public_tokenizers.path(PIECES))
        self.bytes_b = [_piece_bytes(self.pieces.id_to_piece(i))
                        for i in range(self.pieces.get_piece_size())]
        if self.ranks is None or pieces is not None or any("▁" in p[1:] and p.strip("▁") for p in map(
                self.pieces.id_to_piece, range(len(self.bytes_b)))):
            self.plain = None  # another vocabulary may merge across a space
        self.text_a = list(map(str, range(len(self.bytes_a))))
        self.text_b = list(map(str, range(len(self.bytes_b))))
        self.sizes_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(b) for b in self.bytes_b], np.int64)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of space + text by A, and of text by B."""
        a: list = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.ranks is None or self.rare.search(text):
                slow.append(i)
            else:
                a[i] = self.ranks.encode_ordinary(" " + text)
        if slow:
            found = self.tokenizer.encode_batch_fast([" " + texts[i] for i in slow],
                                                     add_special_tokens=False)
            for i, e in zip(slow, found, strict=True):
                a[i] = e.ids
        return a, self.pieces.encode(texts, num_threads=1)

    def slices(self, text: str, a: list[int], b: list[int], step: int = STEP) -> tuple | None:
        """``_Slices`` of an encoded text; None if it is not faithful."""
        if not self.faithful(text, a, b):
            return None
        a, b = np.array(a, "<i4"), np.array(b, "<i4")
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        cuts = common_cuts(ends_a, ends_b, step)
        return _Slices(a, b, np.array(cuts[0], np.int64), np.array(cuts[1], "<i4"), np.array(cuts[2], "<i4"),
                       links(a, b, ends_a, ends_b, cuts), self.group_texts(a, b, *cuts[1:]))

    def group_texts(self, a: np.ndarray, b: np.ndarray, cuts_a, cuts_b) -> list[str]:
        """``a1,a2|b1`` of every group."""
        a = list(map(self.text_a.__getitem__, a.tolist()))
        b = list(map(self.text_b.__getitem__, b.tolist()))
        return [f"{a[i]}|{b[j]}" if k - i == 1 == m - j else f"{','.join(a[i:k])}|{','.join(b[j:m])}"
                for i, k, j, m in zip([0, *cuts_a], cuts_a, [0, *cuts_b], cuts_b, strict=False)]

    def _learn(self, words: list[str]) -> None:
        """Align new words in one text and remember the slices of each."""
        if len(self.words) > MEMO_WORDS:
            for word in list(itertools.islice(self.words, MEMO_WORDS // 2)):  # the oldest
                del self.words[word]
        text = " ".join(words)
        whole = self.slices(text, *(ids[0] for ids in self.encode([text])))
        if whole is None:  # some word is changed by an encoder: find which
            if len(words) == 1:
                self.words[words[0]] = None
                return
            half = len(words) // 2
            self._learn(words[:half])
            self._learn(words[half:])
            return
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        to = (np.searchsorted(whole.ends, ends) + 1).tolist()
        starts = [0, *to[:-1]]  # groups before each word
        counts = np.subtract(to, starts)
        a, b, linked, columns = whole.a.tobytes(), whole.b.tobytes(), whole.links.tobytes(), []
        for cuts in (whole.cuts_a, whole.cuts_b):
            before = np.concatenate([np.zeros(1, "<i4"), cuts])[starts]
            columns += [(before * 4).tolist() + [4 * int(cuts[-1])],
                        (cuts - np.repeat(before, counts)).astype("<i4").tobytes()]
        at_a, cuts_a, at_b, cuts_b = columns
        texts = whole.texts
        for word, g, h, i, k, j, m in zip(words, starts, to, at_a, at_a[1:], at_b, at_b[1:], strict=False):
            self.words[word] = (a[i:k], b[j:m], cuts_a[4 * g:4 * h], cuts_b[4 * g:4 * h],
                                linked[8 * g:8 * h], texts[g] if h - g == 1 else ";".join(texts[g:h]))

    def aligned(self, texts: list[str | None], step: int = STEP):
        """The parts of each text, in order: (ids of A, of B, cuts of A, of B,
        links, text of its groups), all but the last as bytes; no part for a
        text without tokens."""
        split = [None if not t or self.plain is None or not self.plain.fullmatch(t)
                 else t.split(" ") for t in texts]
        used = set().union(*filter(None, split))
        fresh = sorted(used.difference(self.words))
        known = {w: self.words[w] for w in used.difference(fresh)} if len(
            self.words) > MEMO_WORDS else None  # old words may be forgotten now
        if fresh:
            self._learn(fresh)
        if known is None:
            known = self.words
        else:
            known.update((w, self.words[w]) for w in fresh)
        direct = [t for t, parts in zip(texts, split, strict=True) if t and parts is None]
        encoded = zip(direct, *self.encode(direct), strict=True)
        for text, words in zip(texts, split, strict=True):
            if not text:
                yield []
            elif words is None:
                found = self.slices(*next(encoded), step)
                yield [] if found is None else [(
                    found.a.tobytes(), found.b.tobytes(), found.cuts_a.tobytes(), found.cuts_b.tobytes(),
                    found.links.tobytes(), ";".join(found.texts))]
            else:
                parts = list(map(known.__getitem__, words))
                yield [] if None in parts else parts
        for w in fresh:
            if len(w) > MEMO_CHARS:
                del self.words[w]

    def faithful(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether the joined bytes of either encoding are space + text."""
        raw = b" " + text.encode()
        try:
            return (b"".join(map(self.bytes_a.__getitem__, a)) == raw
                    and b"".join(map(self.bytes_b.__getitem__, b)) == raw)
        except IndexError:  # an id outside the vocabulary file
            return False


class _Slices(NamedTuple):
    """An aligned text: ids of A and B, its common ends, the tokens of A and of
    B up to each, the links, and the text of each group."""

    a: np.ndarray
    b: np.ndarray
    ends: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray
    links: np.ndarray
    texts: list


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _piece_bytes(piece: str) -> bytes:
    byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray, step: int = STEP,
                ) -> tuple[list[int], list[int], list[int]]:
    """Every byte offset at which tokens of both end, ascending, with the
    number of A tokens and of B tokens up to it.  The ends must not decrease."""
    ends, cuts_a, cuts_b, i, j = [], [], [], 0, 0
    while i < len(ends_a):
        to = int(np.searchsorted(ends_a, ends_a[min(i + step, len(ends_a)) - 1], "right"))
        to_b = int(np.searchsorted(ends_b, ends_a[to - 1], "right"))
        at_a = dict(zip(ends_a[i:to].tolist(), range(i + 1, to + 1), strict=True))
        at_b = dict(zip(ends_b[j:to_b].tolist(), range(j + 1, to_b + 1), strict=True))
        keys = sorted(at_a.keys() & at_b.keys())
        ends += keys
        cuts_a += map(at_a.__getitem__, keys)
        cuts_b += map(at_b.__getitem__, keys)
        i, j = to, to_b
    return ends, cuts_a, cuts_b


def links(ids_a, ids_b, ends_a, ends_b, cuts) -> np.ndarray:
    """Every pair (A id high, B id low, in 64 bits) of an A token and a B token
    that end together, per slice."""
    ids_a, ids_b = np.asarray(ids_a, np.int64), np.asarray(ids_b, np.int64)
    ends, cuts_a, cuts_b = (np.asarray(c, np.int64) for c in cuts)
    # the tokens of a slice that end at its key: one, and any of no bytes after it
    first_a, first_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    wide, high = cuts_b - first_b, cuts_a - first_a
    if not len(ends) or (wide.max() == 1 and high.max() == 1):
        return ids_a[first_a] << 32 | ids_b[first_b]
    slices = np.repeat(np.arange(len(ends)), wide * high)
    within = np.arange(len(slices)) - np.repeat(np.cumsum(wide * high) - wide * high, wide * high)
    return (ids_a[first_a[slices] + within // wide[slices]] << 32
            | ids_b[first_b[slices] + within % wide[slices]])


_LOADED: dict[tuple, Tokenizers] = {}


def _tokenizers(byte_level: str | None, pieces: str | None) -> Tokenizers:
    key = (byte_level, pieces)
    if key not in _LOADED:
        _LOADED[key] = Tokenizers(byte_level, pieces)
    return _LOADED[key]


#: Columns that ``align`` adds.
ADDED = ("ids_a", "ids_b", "cuts_a", "cuts_b")


def align(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None,
          step: int = STEP) -> DataFrame:
    """``docs`` with ids_a, ids_b, cuts_a and cuts_b (arrays of int) added:
    group g is ``ids_a[cuts_a[g-1]:cuts_a[g]]`` with ``ids_b[cuts_b[g-1]:cuts_b[g]]``
    (from 0 for the first).  Names already taken get an underscore.

    Null or empty text, or text that an encoding does not give back byte for
    byte as space + text: four empty arrays.  A very long text is aligned in
    steps.  Each row stands for itself, so ties and repeated rows do not
    matter; empty table: no rows.  ``byte_level`` and ``pieces`` are paths that
    every executor can read (default: the public vocabularies).
    """
    schema = T.StructType(list(docs.schema.fields) + [
        T.StructField(common.free_name(docs, n), _INTS) for n in ADDED])
    at = docs.columns.index("text")

    def run(batches):
        both = _tokenizers(byte_level, pieces)
        for batch in batches:
            for lo, hi in common.steps(_sizes(batch.column(at)), _GROUP_BYTES):
                part = batch.slice(lo, hi - lo)
                rows = [_joined(parts) for parts in both.aligned(part.column(at).to_pylist(), step)]
                new = [pa.array(column, pa.list_(pa.int32())) for column in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[
                    str(i) for i in range(len(schema))]).rename_columns(schema.names)

    return docs.mapInArrow(run, schema)


def _joined(parts) -> list[np.ndarray]:
    """ids_a, ids_b, cuts_a and cuts_b of a text from its parts."""
    ids = [np.frombuffer(b"".join(p[i] for p in parts), "<i4") for i in (0, 1)]
    cuts = []
    for i in (0, 1):
        moved = np.cumsum([0] + [len(p[i]) // 4 for p in parts])[:-1]
        cuts.append(np.frombuffer(b"".join(p[i + 2] for p in parts), "<i4")
                    + np.repeat(moved, [len(p[i + 2]) // 4 for p in parts]).astype("<i4"))
    return ids + cuts


def _sizes(column) -> np.ndarray:
    """Offsets of the texts of a batch, in bytes."""
    return np.cumsum(np.concatenate([[0], pa.compute.fill_null(pa.compute.binary_length(column), 0)]))


_DIGEST = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()),
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()), T.StructField("n_links", T.LongType()),
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType())])


def digests(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """One row per document (doc_id, text): counts of its alignment, the
    SHA-256 of its groups, and its distinct linked id pairs (64-bit words: A id
    high, B id low, ascending) with how often each is linked."""
    def run(batches):
        from pyspark import TaskContext

        both = _tokenizers(byte_level, pieces)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi in common.steps(_sizes(batch.column(1)), _GROUP_BYTES):
                part = batch.slice(lo, hi - lo)
                out = []
                for doc, parts in zip(
                        part.column(0).to_pylist(), both.aligned(part.column(1).to_pylist()), strict=True):
                    a, b, cuts, _, linked, groups = zip(*parts, strict=True) if parts else ((),) * 6
                    pairs, times = np.unique(np.frombuffer(b"".join(linked), np.int64), return_counts=True)
                    sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if parts else ""
                    out.append((doc, row, sum(map(len, a)) // 4, sum(map(len, b)) // 4,
                                sum(map(len, cuts)) // 4, int(times.sum()), sha,
                                pairs.tobytes(), times.astype("<u4").tobytes()))
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW, strict=True)],
                    names=_DIGEST.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _DIGEST)


_ARROW = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]
_COUNTED = 1 << 21  # pairs summed up at once


def _words(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() or b"" for v in column), kind)


def pair_counts(digest: DataFrame) -> DataFrame:
    """(pair, count, is_best): how many links of the corpus hold each id pair,
    and whether that is the highest count of its B id (ties included)."""
    def run(batches):
        keys, counts, held = [], [], 0

        def summed():
            pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(at, np.concatenate(counts), len(pairs)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total)], names=["pair", "count"])

        for batch in batches:
            for piece in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                keys.append(_words(piece.column(0), "<i8"))
                counts.append(_words(piece.column(1), "<u4").astype(np.float64))
                held += len(keys[-1])
                if held >= _COUNTED:
                    yield summed()
                    keys, counts, held = [], [], 0
        if keys:
            yield summed()

    partial = digest.select("pairs", "times").mapInArrow(run, "pair long, count long")
    total = partial.groupBy("pair").agg(F.sum("count").alias("count"))
    own = Window.partitionBy((F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))  # at most one row per A id
    return total.withColumn("is_best", F.col("count") == F.max("count").over(own))


def _frequent(counts: DataFrame, limit: int) -> int:
    """The least power of two such that at most ``limit`` pairs have a count
    that high (1: all pairs)."""
    log = F.floor(F.log2("count")).cast("int").alias("log")
    sizes = dict(counts.groupBy(log).count().collect())  # at most 63 rows
    total, least = 0, 63
    while least > 0 and total + sizes.get(least - 1, 0) <= limit:
        least -= 1
        total += sizes.get(least, 0)
    return 1 << least


_SUMS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " \
        "n_best long, count_sum long, rest binary, rest_times binary"


def scored(digest: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``digest`` with n_best and count_sum from the corpus-wide ``counts``.

    Counts of frequent pairs (at most ``broadcast_pairs``) travel to the tasks;
    links of the other pairs, each of which occurs fewer times than any
    frequent one, are joined with their counts by a shuffle."""
    spark = digest.sparkSession
    least = _frequent(counts, broadcast_pairs)
    table = counts.where(F.col("count") >= least).sort("pair").toArrow()
    known = spark.sparkContext.broadcast(tuple(
        table.column(i).to_numpy() for i in range(3)))

    def run(batches):
        pairs, count, best = known.value
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            n_best, total, rest, rest_times = [], [], [], []
            for raw, raw_times in zip(columns["pairs"], columns["times"], strict=True):
                keys = np.frombuffer(raw.as_py(), "<i8")
                times = np.frombuffer(raw_times.as_py(), "<u4").astype(np.int64)
                at = np.searchsorted(pairs, keys)
                at[at == len(pairs)] = 0
                hit = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
                at, seen = at[hit], times[hit]
                n_best.append(int(seen[best[at]].sum()))
                total.append(int((seen * count[at]).sum()))
                rest.append(keys[~hit].tobytes())
                rest_times.append(times[~hit].astype("<u4").tobytes())
            keep = [columns[n] for n in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(n_best, pa.int64()), pa.array(total, pa.int64()),
                 pa.array(rest, pa.binary()), pa.array(rest_times, pa.binary())],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                       "n_best", "count_sum", "rest", "rest_times"])

    near = digest.mapInArrow(run, _SUMS)
    if least == 1:  # every pair was known
        return near.drop("row", "rest", "rest_times")
    near = common.written(near, "aligned-frequent")

    def unpack(batches):
        for batch in batches:
            for row, raw, raw_times in zip(*(batch.column(i) for i in range(3)), strict=True):
                keys = np.frombuffer(raw.as_py(), "<i8")
                if len(keys):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), row.as_py())), pa.array(keys),
                         pa.array(np.frombuffer(raw_times.as_py(), "<u4").astype(np.int64))],
                        names=["row", "pair", "times"])

    rare = near.select("row", "rest", "rest_times").mapInArrow(unpack, "row long, pair long, times long")
    sums = (rare.join(counts.where(F.col("count") < least), "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("rare_best"),
                 F.sum(F.col("times") * F.col("count")).alias("rare_sum")))
    return (near.drop("rest", "rest_times").join(sums, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("rare_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("rare_sum", F.lit(0)))
            .drop("row", "rare_best", "rare_sum"))


def corpus_alignment(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None,
                     broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document (doc_id, text; other columns ignored): n_a, n_b, n_groups,
    n_links, n_best, count_sum (long) and groups_sha256, as in ``align``,
    ``pair_counts`` and ``scored``.  A null doc_id stays null; repeated rows are
    documents of their own."""
    digest = common.written(digests(docs, byte_level, pieces), "aligned")
    counts = common.written(pair_counts(digest), "aligned-pairs")
    return scored(digest, counts, broadcast_pairs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_alignment(common.documents(spark, sf_dir))
