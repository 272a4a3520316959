"""Quality classifier: logistic regression over hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

Tokens are maximal runs of letters, of digits, and of other visible bytes;
unigrams, bigrams and the pattern "x ? x" are hashed to 2^BITS weights.  Training rows are dealt to
learners of about LEARNER_ROWS rows by a hash of their id; each learner sweeps
its rows EPOCHS times, one update per document, and the learners' weights are
averaged.
Scoring is a sparse dot product per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BITS = 18
LEARNER_ROWS = 5_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.002, 0.01
#: The classifier is fitted on about so many labelled rows at most, drawn by a
#: hash of the id (the only sample here; scoring covers every row).
MAX_TRAIN_ROWS = 40_000

_HASH = common.RollingHash(5)
_CLASS = np.full(256, 3, np.uint8)  # 0 space, 1 letter, 2 digit, 3 other
_CLASS[common.SPACE] = 0
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[ord("A"):ord("Z") + 1] = _CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[0x80:] = 1
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_AGAIN = np.uint64(0x3C6EF372FE94F82B)


def features(array):
    """For each step of documents: (documents in it, feature numbers, values,
    document of each), values being counts scaled to unit length."""
    data, offsets = common.buffers(array)
    for i, j in common.steps(offsets):
        own = data[offsets[i]:offsets[j]]
        marks = offsets[i:j + 1] - offsets[i]
        starts, ends, doc = common.runs(_CLASS[own], marks)
        word = _HASH.spans(_HASH.prefix(own), starts, ends)
        same = doc[1:] == doc[:-1]
        pair = common.mix(word[:-1] * _PAIR + word[1:])[same]
        again = doc[2:][(doc[2:] == doc[:-2]) & (word[2:] == word[:-2])]  # a token two places on
        number = np.concatenate([word, pair, np.full(len(again), _AGAIN)]) >> np.uint64(64 - BITS)
        row = np.concatenate([doc, doc[:-1][same], again])
        key = (row << BITS) | number.astype(np.int64)
        key.sort()
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.r_[first, len(key)]).astype(np.float64)
        key = key[first]
        row = key >> BITS
        norm = np.sqrt(np.bincount(row, count * count, minlength=j - i))
        yield j - i, key & ((1 << BITS) - 1), count / norm[row] if len(row) else count, row


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Learner:
    """FTRL-proximal state of one learner; weight 2^BITS is the bias."""

    def __init__(self):
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at):
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, at, x, y):
        w = self.weights(at)
        g = (_sigmoid(float(w @ x)) - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, label: str = "quality",
          max_rows: int = MAX_TRAIN_ROWS, learner_rows: int = LEARNER_ROWS) -> np.ndarray:
    """Averaged weights (2^BITS and a bias) from the rows of ``docs`` with a 0/1
    label; all zero (every score 0.5) if there are none.  Several labels of
    one id, or several rows of it, all count."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("double").alias("y"))
    total = known.count()
    shards = max(1, round(min(total, max_rows) / learner_rows))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
    share = min(1_000_000, 1_000_000 * max_rows // max(1, total))
    rows = (docs.select("doc_id", "text").where(draw < share)
            .join(known.where(draw < share), "doc_id")
            .select(F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(shards)).cast("int").alias("shard"),
                    F.xxhash64("doc_id", F.lit(13)).alias("turn"), "y", "text")
            .repartition(shards, "shard").sortWithinPartitions("shard", "turn", "y", "text"))

    def learn(batches):
        examples: dict[int, list] = {}
        for batch in batches:
            shard, y = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            base = 0
            for n, number, value, row in features(batch.column(3)):
                cut = np.searchsorted(row, np.arange(n + 1))
                for k in range(n):
                    own = slice(cut[k], cut[k + 1])
                    examples.setdefault(int(shard[base + k]), []).append((
                        np.append(number[own], 1 << BITS).astype(np.int32),
                        np.append(value[own], 1.0).astype(np.float32), y[base + k]))
                base += n
        for own in examples.values():
            learner = Learner()
            for _ in range(EPOCHS):
                for at, x, y in own:
                    learner.update(at, x, y)
            w = learner.weights(slice(None)).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.tobytes()], pa.binary()), pa.array([len(own)], pa.int64())], names=["w", "n"])

    out, seen = np.zeros((1 << BITS) + 1), 0
    for r in rows.mapInArrow(learn, "w binary, n long").collect():  # one row per learner
        out += np.frombuffer(r["w"], "<f4").astype(float) * r["n"]
        seen += r["n"]
    return (out / max(1, seen)).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with score (double, 0 to 1) and predicted (int, 1 from 0.5)
    added; names already taken get an underscore.  Null and empty texts get
    the bias alone.  Rows are scored one by one, so order, ties and repeated
    rows do not matter; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make(array):
        w = shared.value
        out = [np.zeros(0)]
        for n, number, value, row in features(array):
            out.append(_sigmoid(np.bincount(row, w[number] * value, minlength=n) + float(w[-1])))
        got = np.concatenate(out)
        return [pa.array(got, pa.float64()), pa.array((got >= 0.5).astype(np.int32), pa.int32())]

    names = [common.free_name(docs, n) for n in ("score", "predicted")]
    return common.append_columns(docs, make, list(zip(
        names, (T.DoubleType(), T.IntegerType()), strict=True)), text)


def held_out() -> Column:
    return common.text_fold() % 3 == 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    weights = train(docs.where(~held_out()), common.documents(spark, sf_dir, "labels"))
    return score(docs, weights).select("doc_id", held_out().alias("held_out"), "score", "predicted")
