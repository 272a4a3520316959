"""Language identification by multilingual mixture inference.

Training counts hashed byte trigrams of all labelled training texts, one
distribution per language.  A document is then a mixture: expectation
maximisation estimates the proportion of each language from the likelihoods of
its trigrams, for all documents of a batch at once.  The language set is grown
in the order of the proportions and chosen by penalised likelihood: a further
language must raise the log likelihood by more than its penalty.  The empty
set is the null model in which every trigram is equally likely; where it wins,
no learned language explains the text.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Trigrams are hashed to so many values.
BUCKETS = 1 << 14
#: Letters from which on the pipeline rejects a text that no language explains.
JUDGED = 40
SMOOTHING = 0.05
ITERATIONS = 6
#: Log likelihood that a further language must bring, times the log of the trigrams.
PENALTY = 4.0
#: Documents handled together: cells of the (document, trigram) count table.
CELLS = 1 << 21

_LETTER = re.compile(r"[^\W\d_]")
_KIND = np.full(256, 0x20, np.uint32)
_KIND[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KIND[0x80:] = np.arange(0x80, 256)


def _grams(array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams with a letter in them, and their documents."""
    data, offsets = common.buffers(pc.utf8_lower(array))
    kind = _KIND[data]
    if len(kind) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = kind[:-2], kind[1:-1], kind[2:]
    mixed = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B) ^ c * np.uint32(0xC2B2AE35)
    bucket = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(18)
    keep = (a != 0x20) | (b != 0x20) | (c != 0x20)
    borders = np.concatenate([offsets[1:-1] - 1, offsets[1:-1] - 2])
    keep[borders[(borders >= 0) & (borders < len(keep))]] = False  # spans of two documents
    at = np.flatnonzero(keep)
    return bucket[at].astype(np.int64), np.searchsorted(offsets, at, "right") - 1


def _parts(array, limit: int = common.STEP_BYTES):
    """Slices of a string array of at most ``limit`` bytes (one long text: alone)."""
    _, offsets = common.buffers(array)
    for i, j in common.steps(offsets, limit):
        yield array.slice(i, j - i)


def train(docs: DataFrame, lang: str = "lang", text: str = "text"):
    """(languages, log probabilities [languages, BUCKETS]) from every row whose
    language and text are not null.  What reaches the driver is one count per
    language and bucket, whatever the size of ``docs``."""
    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(0)
            for value in pc.unique(labels).to_pylist():
                own = batch.column(1).filter(pc.equal(labels, value))
                sums = totals.setdefault(value, np.zeros(BUCKETS, np.int64))
                for part in _parts(own):
                    sums += np.bincount(_grams(part)[0], minlength=BUCKETS)
        for value, sums in totals.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([value] * len(at), pa.string()), pa.array(at, pa.int32()),
                 pa.array(sums[at], pa.int64())], names=["lang", "bucket", "n"])

    rows = (docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
            .select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
            .mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS, len(langs)))
    counts[rows["bucket"], rows["lang"].map({x: i for i, x in enumerate(langs)})] = rows["n"]
    smooth = counts + SMOOTHING
    return langs, np.ascontiguousarray(np.log(smooth / smooth.sum(0)).T, np.float32)


def _mixture(prob, counts, starts, doc, weight, allowed, iterations=ITERATIONS):
    """EM for all documents: proportions [langs, docs] and log likelihoods."""
    share = allowed / allowed.sum(0)
    for _ in range(iterations):
        joint = prob * share[:, doc]
        joint *= counts / joint.sum(0)
        share = np.add.reduceat(joint, starts, axis=1) / weight
    total = (prob * share[:, doc]).sum(0)
    return share, np.add.reduceat(counts * np.log(np.maximum(total, 1e-30)), starts)


def infer(logp: np.ndarray, buckets: np.ndarray, docs: np.ndarray, n_docs: int):
    """Best language, its proportion and the size of the chosen set (0: the
    null model) of each document; -1, 0, 0 for one without trigrams.
    ``logp``: [langs, BUCKETS]."""
    best, score, size = np.full(n_docs, -1), np.zeros(n_docs), np.zeros(n_docs, np.int64)
    n_langs = len(logp)
    if not len(buckets) or not n_langs:
        return best, score, size
    table = np.bincount(docs * BUCKETS + buckets, minlength=n_docs * BUCKETS)
    cell = np.flatnonzero(table)
    counts = table[cell].astype(np.float32)
    row = cell // BUCKETS
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    present, n = row[starts], len(starts)
    local = np.repeat(np.arange(n), np.diff(np.r_[starts, len(row)]))
    logs = logp[:, cell % BUCKETS]
    prob = np.exp(logs)
    weight = np.add.reduceat(counts, starts)
    single = np.add.reduceat(logs * counts, starts, axis=1)
    full, _ = _mixture(prob, counts, starts, local, weight, np.ones((n_langs, n), np.float32))
    pick = np.argmax(single, axis=0)
    full[pick, np.arange(n)] = 2  # the best single language comes first
    order = np.argsort(-full, axis=0, kind="stable")
    value = single[pick, np.arange(n)]
    chosen = np.ones(n, np.int64)
    shares = np.zeros((n_langs, n), np.float32)
    shares[pick, np.arange(n)] = 1
    growing = np.arange(n)  # documents whose set may take a k-th language
    for k in range(2, n_langs + 1):
        inside = np.isin(local, growing) if len(growing) < n else slice(None)
        sub = local[inside]
        if not len(sub):
            break
        allowed = np.zeros((n_langs, n), np.float32)
        np.put_along_axis(allowed, order[:k], 1, axis=0)
        firsts = np.flatnonzero(np.r_[True, sub[1:] != sub[:-1]])
        renumber = np.repeat(np.arange(len(growing)), np.diff(np.r_[firsts, len(sub)]))
        share, like = _mixture(prob[:, inside], counts[inside], firsts, renumber, weight[growing],
                               allowed[:, growing])
        gain = like - value[growing] > PENALTY * np.log(weight[growing] + 1)
        won = growing[gain]
        value[won], shares[:, won], chosen[won] = like[gain], share[:, gain], k
        growing = won
    best[present] = np.argmax(shares, axis=0)
    score[present] = np.max(shares, axis=0)
    size[present] = np.where(value > -weight * math.log(BUCKETS), chosen, 0)
    return best, score, size


def identify(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred (string), score (double, the proportion of that
    language in the text) and n_langs (long, size of the chosen set) added;
    names already taken get an underscore.

    lang_pred is ``und`` (score 0, n_langs 0) for a null text, one without a
    letter, or a model without languages; else a learned language, with
    n_langs 0 where no language explains the text better than chance.  Letters
    too few for a trigram get the first language, score 0.  Rows are judged
    one by one, so order, ties and repeated rows do not matter; an empty table
    gives an empty result.
    """
    langs, logp = model
    shared = docs.sparkSession.sparkContext.broadcast(logp)  # languages x BUCKETS numbers

    def make(array):
        preds, scores, sizes = [], [], []
        for part in _parts(array):
            buckets, at = _grams(part)
            cuts = np.searchsorted(at, np.arange(0, len(part) + 1))
            step = max(1, CELLS // BUCKETS)
            for i in range(0, len(part), step):
                j = min(i + step, len(part))
                own = slice(cuts[i], cuts[j])
                best, score, size = infer(shared.value, buckets[own], at[own] - i, j - i)
                for k, value in enumerate(part.slice(i, j - i).to_pylist()):
                    if not langs or value is None or not _LETTER.search(value):
                        preds.append("und")
                        scores.append(0.0)
                        sizes.append(0)
                    else:
                        preds.append(langs[max(0, best[k])])
                        scores.append(min(1.0, float(score[k])))
                        sizes.append(int(size[k]))
        return [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())]

    names = [common.free_name(docs, n) for n in ("lang_pred", "score", "n_langs")]
    return common.append_columns(docs, make, list(zip(
        names, (T.StringType(), T.DoubleType(), T.LongType()), strict=True)), text)


def held_out() -> Column:
    return common.text_fold() % 4 == 2


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = train(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_langs")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that a learned language explains stay, and so do
    those with letters, but fewer than JUDGED, that chance explains no worse: a few
    trigrams not seen in training decide nothing."""
    columns = docs.columns
    model = train(docs.where(~held_out()))
    pred, size = common.free_name(docs, "lang_pred"), common.free_name(docs, "n_langs")
    return identify(docs, model).where(
        (F.col(pred) != "und") & ((F.col(size) > 0) | (F.length(F.regexp_replace(
            "text", r"[^\p{L}\p{M}]", "")) < JUDGED))).select(*columns)
