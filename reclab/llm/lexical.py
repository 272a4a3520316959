"""Ranked lexical search by bag deduplication.

Documents are cut down to the terms that occur in the items: a bag is the
sorted vector of (term, tf) over that vocabulary.  With the length class m it
decides every score, so documents with the same bag and m form a class (dealt
by a hash of both, equal only if all bytes are).  A class is scored once
against all items, as a matrix product; each item keeps its best classes,
and these expand to their members by ascending doc_id.

Two prunings lose nothing: of a class only the k smallest doc_ids can be
returned, and of the classes of an item only the k best by (score, smallest
doc_id), since each class ahead of another puts at least its smallest doc_id
ahead of all of its members.

Items are searched in blocks, so that the vocabulary and the weights that
travel to the tasks stay bounded; each block reads all documents.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

TOP = 20
#: Items and distinct terms of a block (an item with more terms is a block by itself).
BLOCK_ITEMS, BLOCK_TERMS = 512, 16_384
#: Cells of the score matrix, or of the bag matrix, of one step.
_CELLS = 1 << 20

#: Term bytes: ASCII digits and letters (capitals made small) and all bytes of
#: other characters; the rest become spaces.
_TO_TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return raw.translate(_TO_TERMS).split()


class Block:
    """Some items: their ids, vocabulary, and how often each item has each term."""

    def __init__(self):
        self.items: list[int] = []
        self.vocabulary: dict[bytes, int] = {}
        self.cells: list[tuple[int, int, int]] = []  # (term, item position, times)

    def add(self, item: int, words: Counter) -> None:
        for word, times in words.items():
            self.cells.append((self.vocabulary.setdefault(word, len(self.vocabulary)), len(self.items), times))
        self.items.append(item)

    def fits(self, words: Counter) -> bool:
        fresh = sum(w not in self.vocabulary for w in words)
        return not self.items or (len(self.items) < BLOCK_ITEMS and len(self.vocabulary) + fresh <= BLOCK_TERMS)


def blocks(items: DataFrame):
    """Blocks of the items (item_id, text), by ascending id.  An id that occurs
    again is searched once, with its smallest text; null ids take no part."""
    one = (items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
           .where(F.col("item_id").isNotNull()).groupBy("item_id").agg(F.min("text").alias("text"))
           .sort("item_id"))
    block = Block()
    for row in one.toLocalIterator():  # a block at a time is held
        words = Counter(terms(row.text.encode()))
        if not block.fits(words):
            yield block
            block = Block()
        block.add(row.item_id, words)
    if block.items:
        yield block


_BAGS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()),
                      T.StructField("n", T.LongType()), T.StructField("bag", T.BinaryType())])


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row per document: n, all its terms with repeats, and its bag: 32-bit
    pairs (term number, tf), ascending."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        from pyspark import TaskContext

        numbers = known.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            counts, found = [], []
            for value in batch.column(1).cast(pa.large_binary()):
                raw = value.as_buffer()
                words = terms(raw.to_pybytes()) if raw is not None else []
                counts.append(len(words))
                tf = Counter(map(numbers.get, words))
                tf.pop(None, None)
                found.append(np.array(sorted(tf.items()), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(range(row, row + len(counts)), pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(found, pa.binary())], names=_BAGS.names)
            row += len(counts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _BAGS)


def _document_counts(table: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            raw = np.frombuffer(b"".join(v.as_py() for v in batch.column(0)), "<u4")
            total += np.bincount(raw[::2], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for row in (table.select("bag").mapInArrow(run, "term long, df long")
                .groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator()):
        out[row.term] = row.df
    return out


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _best_classes(classes: DataFrame, matrix: np.ndarray, weights: np.ndarray, k: int) -> DataFrame:
    """(item, score, cls) of the best ``k`` classes (cls, first, m, bag) of every
    item, by score and then by the smallest doc_id ``first``."""
    size, n_items = matrix.shape
    # a score is a sum of integers: in doubles exact below 2^53 (half of it leaves room for this sum's rounding)
    exact = float((weights.astype(np.float64) @ matrix.astype(np.float64)).max()) * 1e6 < 2**52
    sent = classes.sparkSession.sparkContext.broadcast(
        (matrix.astype(np.float64 if exact else np.int64), weights))

    def run(batches):
        table, w = sent.value
        step = max(1, _CELLS // max(size, n_items))
        least = np.ones(n_items, np.int64)  # below it an item needs no class
        kept = np.zeros((4, 0), np.int64)  # item, score, first, cls
        fresh, held = [], 0

        def prune():
            nonlocal kept, fresh, held
            kept = np.concatenate([kept, *fresh], axis=1)
            order = np.lexsort((kept[2], -kept[1], kept[0]))
            kept = kept[:, order]
            starts = np.searchsorted(kept[0], kept[0])
            kept = kept[:, np.arange(kept.shape[1]) - starts < k]
            last = np.flatnonzero(np.arange(kept.shape[1]) - np.searchsorted(kept[0], kept[0]) == k - 1)
            least[kept[0][last]] = kept[1][last]
            fresh, held = [], 0

        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                cls, first, m = (batch.column(i).to_numpy() for i in range(3))
                raw = [np.frombuffer(v.as_py(), "<u4") for v in batch.column(3)]
                rows = np.repeat(np.arange(len(raw)), [len(r) // 2 for r in raw])
                flat = np.concatenate(raw).astype(np.int64)
                term, tf = flat[::2], flat[1::2]
                gain = w[term] * ((10**9 * tf) // (1000 * tf + 12 * m[rows]))
                dense = np.zeros((len(raw), size), table.dtype)
                dense[rows, term] = gain
                scores = (dense @ table).astype(np.int64)
                at, item = np.nonzero(scores >= least)
                fresh.append(np.stack([item, scores[at, item], first[at], cls[at]]))
                held += len(at)
                if held >= _CELLS // 4:
                    prune()
        prune()
        yield pa.RecordBatch.from_arrays([pa.array(kept[i]) for i in (0, 1, 2, 3)],
                                         names=["item", "score", "first", "cls"])

    best = classes.select("cls", "first", "m", "bag").mapInArrow(
        run, "item long, score long, first long, cls long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "cls")
    return best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("item", "score", "cls")


_RANKED = "item_id long, rank int, doc_id long, score long"


def _search(docs: DataFrame, block: Block, k: int) -> DataFrame:
    spark = docs.sparkSession
    size = len(block.vocabulary)
    if not size:
        return spark.createDataFrame([], _RANKED)
    table = common.written(bags(docs, block.vocabulary), "bags")
    total = table.agg(F.sum((F.col("n") > 0).cast("long")).alias("documents"), F.sum("n").alias("terms")).first()
    if not total.terms:
        return spark.createDataFrame([], _RANKED)
    df = _document_counts(table, size)
    weights = np.array([weight(total.documents, int(x)) for x in df], np.int64)
    matrix = np.zeros((size, len(block.items)), np.int64)
    for term, item, times in block.cells:
        matrix[term, item] = times

    m = F.expr(f"75 + ((25 * n * {total.documents}L) div {total.terms}L)")
    same = Window.partitionBy("h", "m", "bag").orderBy("doc_id", "row")
    members = common.written(
        table.where(F.col("doc_id").isNotNull() & (F.length("bag") > 0)).withColumn("m", m)
        .withColumn("h", F.xxhash64("bag", "m"))
        .withColumn("r", F.row_number().over(same)).where(F.col("r") <= k)
        .withColumn("cls", F.first("row").over(same))
        .withColumn("bag", F.when(F.col("r") == 1, F.col("bag")))
        .select("cls", "r", "doc_id", "row", "m", "bag"), "bag-members")
    classes = members.where(F.col("r") == 1).withColumnRenamed("doc_id", "first")
    best = _best_classes(classes, matrix, weights, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id", "row")
    ranked = (best.join(members.select("cls", "doc_id", "row"), "cls")
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    names = spark.createDataFrame(list(enumerate(block.items)), "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of every item (item_id, text):
    item_id, rank (int, from 1), doc_id, score (long, above 0); equal scores by
    ascending doc_id.

    Null, empty or term-free documents score nothing and are not among the N
    documents; null, empty or term-free items have no rows.  A repeated row is
    a document of its own (its doc_id may appear more than once); documents
    without an id count in all statistics and are not returned.  A repeated
    item_id is searched once, with its smallest text.  Texts are read whole,
    whatever their length.  Other columns are ignored; empty tables: no rows.
    """
    out = None
    for block in blocks(items):
        found = _search(docs, block, k)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], _RANKED) if out is None else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(common.documents(spark, sf_dir), common.documents(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE_SQL = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS.format("text")}) AS term FROM documents WHERE text IS NOT NULL),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY ALL),
total AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM lengths),
ms AS (SELECT doc_id, 75 + ((25 * n * nd) // nt) AS m FROM lengths, total),
asked AS (SELECT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark WHERE text IS NOT NULL),
wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
ws AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM dfs, total),
scores AS (
    SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM wanted JOIN ws USING (term) JOIN tfs USING (term) JOIN ms USING (doc_id) GROUP BY ALL),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
        doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
