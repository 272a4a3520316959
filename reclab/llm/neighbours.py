"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample of the vectors (``SAMPLE_ROWS``, ``SAMPLE_VALUES``):

1. the neighbour graph: the ``GRAPH_DEGREE`` nearest sample rows of each,
   found by Spark tasks in blocks;
2. balanced partitioning: a balanced start by median cuts, then moves of nodes
   to the part where more of their neighbours are, while it has room;
3. routing: a small network with one hidden layer learns, from a vector alone,
   the shares of its neighbours in each part;
4. calibration: rows held out of 1 to 3 tell how much probability a query has
   to cover to find ``TARGET`` of its true neighbours.

Index: every row goes to its most probable part.  Search: a query probes its
most probable parts until their sum reaches the calibrated share, and the rows
there are reranked by exact distance.  Parts are cut into blocks by size, and
so are the queries that meet them, so a hot part is many tasks and no task
holds more than a block of either.

Equal vectors form a class of which the k + 1 smallest ids are indexed (no
query can return more), and are asked once for all queries that have them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

TOP = 10
#: Bounds of the sample: rows, and numbers in all of its vectors.
SAMPLE_ROWS, SAMPLE_VALUES = 12_000, 1 << 21
#: One row of the sample in so many is held out for calibration.
HELD_OUT = 10
GRAPH_DEGREE = 10
#: Share of the true neighbours that calibration has to reach on held-out rows.
TARGET = 0.97
MAX_PARTS = 256
HIDDEN, EPOCHS = 128, 30
#: Rows of a part, and queries, that meet in one block.
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 1_024
_CELLS = 1 << 21


def nearest(queries: np.ndarray, rows: np.ndarray, k: int, ids: np.ndarray | None = None,
            own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact distances of the ``k`` nearest rows of each query,
    ties to the smaller ``ids`` (default: position); ``own``: the position that
    a query may not return, or -1.  Missing ones: position -1."""
    ids = np.arange(len(rows)) if ids is None else ids
    at = np.full((len(queries), k), -1, np.int64)
    far = np.full((len(queries), k), np.inf)
    norms = (rows * rows).sum(axis=1)
    step = max(1, _CELLS // max(1, len(rows)))
    for lo in range(0, len(queries), step):
        q = queries[lo:lo + step]
        size = (q * q).sum(axis=1)
        # rounding of the expanded square stays far below this slack
        slack = 1e-9 * (size + norms.max(initial=0.0))
        square = norms[None] - 2.0 * (q @ rows.T) + size[:, None]
        if own is not None:
            mine = np.flatnonzero(own[lo:lo + step] >= 0)
            square[mine, own[lo:lo + step][mine]] = np.inf
        take = min(k, len(rows))
        kth = np.partition(square, take - 1, axis=1)[:, take - 1] if take else np.zeros(len(q))
        i, j = np.nonzero(~(square > (kth + slack)[:, None]) & ~np.isinf(square))
        d = np.empty(len(i))
        for a in range(0, len(i), 1 << 14):  # exact distances of the short list
            b = slice(a, a + (1 << 14))
            d[b] = np.sqrt(((q[i[b]] - rows[j[b]]) ** 2).sum(axis=1))
        order = np.lexsort((ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        r = np.arange(len(i)) - np.searchsorted(i, i)
        keep = r < k
        at[lo + i[keep], r[keep]], far[lo + i[keep], r[keep]] = j[keep], d[keep]
    return at, far


def balanced_parts(graph: np.ndarray, rows: np.ndarray, parts: int, rounds: int = 8, slack: float = 1.1,
                   seed: int = 11) -> np.ndarray:
    """A part for every node of the neighbour ``graph`` (positions, -1: none),
    none larger than ``slack`` times the mean (rounded up)."""
    n = len(rows)
    part = np.zeros(n, np.int64)
    rng = np.random.RandomState(seed)

    def halve(members, lo, hi):  # balanced start: median cuts along the widest of a few directions
        if hi - lo == 1:
            part[members] = lo
            return
        mid = (lo + hi) // 2
        if len(members):
            x = rows[members] @ rng.standard_normal((rows.shape[1], 8))
            members = members[np.argsort(x[:, x.var(axis=0).argmax()], kind="stable")]
        cut = len(members) * (mid - lo) // (hi - lo)
        halve(members[:cut], lo, mid)
        halve(members[cut:], mid, hi)

    halve(np.arange(n), 0, parts)
    room = int(np.ceil(slack * n / parts))
    a, b = np.nonzero(graph >= 0)
    b = graph[a, b]
    ends, heads = np.concatenate([a, b]), np.concatenate([b, a])  # both directions
    order = np.argsort(ends, kind="stable")
    heads = heads[order]
    first = np.searchsorted(ends[order], np.arange(n + 1))
    sizes = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        shares = np.zeros((n, parts), np.int32)
        np.add.at(shares, (ends, part[np.concatenate([b, a])]), 1)
        gain = shares.max(axis=1) - shares[np.arange(n), part]
        moved = 0
        for node in np.argsort(-gain, kind="stable")[:int((gain > 0).sum())]:
            near = np.bincount(part[heads[first[node]:first[node + 1]]], minlength=parts)
            near[(sizes >= room) & (np.arange(parts) != part[node])] = -1
            to = int(near.argmax())
            if near[to] > near[part[node]]:
                sizes[part[node]] -= 1
                sizes[to] += 1
                part[node] = to
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A network with one hidden layer: a vector's probability of each part."""

    def __init__(self, rows: np.ndarray, shares: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS,
                 seed: int = 11):
        rng = np.random.RandomState(seed)
        self.mean = rows.mean(axis=0)
        self.scale = 1.0 / np.maximum(rows.std(axis=0), 1e-12)
        x = self._input(rows)
        d, parts = rows.shape[1], shares.shape[1]
        self.layers = [rng.standard_normal((d, hidden)) * np.sqrt(2.0 / d), np.zeros(hidden),
                       rng.standard_normal((hidden, parts)) * np.sqrt(1.0 / hidden), np.zeros(parts)]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.layers]
        t = 0
        for epoch in range(epochs):
            rate = 2e-3 * (1 - epoch / epochs)
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 256):
                some = order[lo:lo + 256]
                h = np.maximum(x[some] @ self.layers[0] + self.layers[1], 0)
                error = (_softmax(h @ self.layers[2] + self.layers[3]) - shares[some]) / len(some)
                back = (error @ self.layers[2].T) * (h > 0)
                slopes = [x[some].T @ back, back.sum(axis=0), h.T @ error, error.sum(axis=0)]
                t += 1
                for w, g, (m, v) in zip(self.layers, slopes, moments, strict=True):
                    g = g + 1e-4 * w
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def _input(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) * self.scale, -1e6, 1e6)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        h = np.maximum(self._input(rows) @ self.layers[0] + self.layers[1], 0)
        return _softmax(h @ self.layers[2] + self.layers[3])

    def part(self, rows: np.ndarray) -> np.ndarray:
        return self.probabilities(rows).argmax(axis=1)

    def probes(self, rows: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) pairs: each row's most probable parts until they sum to ``share``."""
        p = self.probabilities(rows)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        before = np.concatenate([np.zeros((len(p), 1)), before[:, :-1]], axis=1)
        i, j = np.nonzero(before < share)
        return i, order[i, j]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _graph(spark: SparkSession, queries: np.ndarray, rows: np.ndarray, k: int, own: bool) -> np.ndarray:
    """The ``k`` nearest ``rows`` of each of the ``queries`` (both of the sample), by Spark tasks."""
    sent = spark.sparkContext.broadcast((queries, rows))
    step = 1024

    def run(batches):
        q, x = sent.value
        for batch in batches:
            for lo in (i * step for i in batch.column(0).to_pylist()):
                some = np.arange(lo, min(lo + step, len(q)))
                at, _ = nearest(q[some], x, k, own=some if own else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(list(at), pa.list_(pa.int64()))], names=["node", "near"])

    count = -(-len(queries) // step)
    out = np.full((len(queries), k), -1, np.int64)
    found = (spark.range(0, count, 1, max(1, count)).mapInArrow(run, "node long, near array<long>")).toArrow()
    if found.num_rows:
        out[found.column(0).to_numpy()] = np.array(found.column(1).to_pylist())
    return out


class Partitions:
    """The fitted router and the calibrated probability share."""

    def __init__(self, spark: SparkSession, sample: np.ndarray, parts: int, target: float = TARGET):
        held = np.arange(len(sample)) % HELD_OUT == HELD_OUT - 1 if len(sample) >= 100 else np.zeros(len(sample), bool)
        rows, asked = sample[~held], sample[held]
        k = min(GRAPH_DEGREE, max(1, len(rows) - 1))
        graph = _graph(spark, rows, rows, k, own=True)
        self.assigned = balanced_parts(graph, rows, parts)
        shares = np.zeros((len(rows), parts))
        a, b = np.nonzero(graph >= 0)
        np.add.at(shares, (a, self.assigned[graph[a, b]]), 1.0)
        np.add.at(shares, (np.arange(len(rows)), self.assigned), 1.0)
        self.router = Router(rows, shares / shares.sum(axis=1, keepdims=True))
        self.share = 1.0  # every part, unless held-out rows show that fewer do
        if len(asked):
            near = _graph(spark, asked, rows, k, own=False)
            home = self.router.part(rows)
            p = self.router.probabilities(asked)
            at_home = np.take_along_axis(p, home[near], axis=1)  # of the part of each true neighbour
            # found if the parts more probable than it sum to less than the share
            ranked = -np.sort(-p, axis=1)
            above = np.cumsum(ranked, axis=1) - ranked
            place = (ranked[:, None, :] > at_home[:, :, None]).sum(axis=2)
            needed = np.take_along_axis(above, place, axis=1)
            self.share = float(min(1.0, np.quantile(needed, target, method="higher") + 1e-9))


def _vector(column: str) -> Column:
    return F.transform(column, lambda x: x.cast("double"))


def usable(table: DataFrame, ids: str = "vec_id", vectors: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part: an id, and a vector of the most
    common length (ties: the shorter) that is not zero and holds only finite
    numbers."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (table.select(F.col(ids).cast("long").alias("vec_id"), _vector(vectors).alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (size.d if size else 0))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def search(table: DataFrame, is_query: Column, k: int = TOP, ids: str = "vec_id", vectors: str = "embedding",
           sample_rows: int = SAMPLE_ROWS, parts: int | None = None, target: float = TARGET,
           seed: int = 11) -> DataFrame:
    """The ``k`` nearest rows found for every row where ``is_query`` (a
    condition on ``vec_id``) holds: query_id, rank (int, from 1), vec_id, score
    (double: exact Euclidean distance); nearest first, ties to smaller ids.

    Candidates are all rows but those with the query's own id.  Rows without an
    id, and vectors that are null, zero, of another length than the most common
    one or with a null or non-finite component take no part.  A row repeated
    with the same id and vector counts once; an id with several vectors is
    several candidates, and asks with its smallest vector.  Other columns are
    ignored; an empty table gives no rows.  ``sample_rows`` bounds what the
    index is fitted on; every row is indexed.
    """
    spark = table.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    same = Window.partitionBy("h", "v").orderBy("vec_id")
    rows = usable(table, ids, vectors).withColumn("h", F.xxhash64("v", F.lit(seed)))
    members = common.written(
        rows.withColumn("r", F.dense_rank().over(same)).where(F.col("r") <= k + 1)
        .dropDuplicates(["h", "v", "vec_id"]).select("vec_id", "v", "h"), "vectors")
    asking = (rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
              .select(F.col("vec_id").alias("query_id"), "v"))
    # queries with equal vectors are one question, named by the smallest of them
    asking = common.written(asking.withColumn("q", F.min("query_id").over(Window.partitionBy("v"))), "queries")
    questions = asking.where(F.col("q") == F.col("query_id")).select("q", "v")
    n = members.count()
    if not n:
        return empty

    dim = members.select(F.size("v")).first()[0]
    bound = max(2, min(sample_rows, SAMPLE_VALUES // dim))
    fraction = min(1.0, bound / n)
    drawn = members.where(F.pmod(F.col("h"), F.lit(1 << 30)) < int(fraction * (1 << 30))).select("h", "v").toArrow()
    drawn = drawn.combine_chunks()
    order = np.argsort(drawn.column("h").to_numpy() if drawn.num_rows else np.zeros(0, np.int64), kind="stable")[:bound]
    sample = _matrix(drawn.column("v").combine_chunks())[order] if len(order) else np.zeros((0, dim))
    if parts is None:
        parts = min(MAX_PARTS, max(4, round(n**0.5 / 4)))
    parts = max(1, min(parts, len(sample) // 8))
    fitted = Partitions(spark, sample, parts, target) if parts > 1 else None
    sent = spark.sparkContext.broadcast((fitted.router, fitted.share) if fitted else (None, 1.0))

    def home(batches):
        router, _ = sent.value
        for batch in batches:
            part = router.part(_matrix(batch.column(1))) if router else np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=["vec_id", "v", "part"])

    def probe(batches):
        router, share = sent.value
        for batch in batches:
            if router is None:
                i, part = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            else:
                i, part = router.probes(_matrix(batch.column(1)), share)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(i)), batch.column(1).take(pa.array(i)), pa.array(part)],
                names=["q", "v", "part"])

    indexed = members.select("vec_id", "v").mapInArrow(home, "vec_id long, v array<double>, part long")
    routed = common.written(questions.mapInArrow(probe, "q long, v array<double>, part long"), "probes")
    # blocks of both sides, from counts of at most MAX_PARTS parts
    row_blocks, query_blocks = ({part: -(-count // limit) for part, count in sized.groupBy("part").count().collect()}
                                for sized, limit in ((indexed, BLOCK_ROWS), (routed, BLOCK_QUERIES)))

    def blocked(df, key, own, other, mine, theirs):
        """``df`` with its block and one row for each block of the other side."""
        one = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, own.get(p, 1))])
        two = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, other.get(p, 1))])
        return (df.withColumn(mine, F.pmod(F.xxhash64(key, F.lit(seed)), one[F.col("part").cast("int")]).cast("int"))
                .withColumn(theirs, F.explode(F.sequence(F.lit(0), two[F.col("part").cast("int")] - 1)))
                if other else df.where(F.lit(False)).withColumn(mine, F.lit(0)).withColumn(theirs, F.lit(0)))

    return _reranked(spark, asking, blocked(indexed.where(F.col("part").isin(list(query_blocks))), "vec_id",
                                            row_blocks, query_blocks, "row_block", "query_block"),
                     blocked(routed.where(F.col("part").isin(list(row_blocks))), "q",
                             query_blocks, row_blocks, "query_block", "row_block"), k)


def _reranked(spark, asking: DataFrame, rows: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    def rerank(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        ids = left.column("vec_id").to_numpy()
        at, far = nearest(_matrix(right.column("v").combine_chunks()), _matrix(left.column("v").combine_chunks()),
                          k + 1, ids)
        i, j = np.nonzero(at >= 0)
        return pa.table({"q": right.column("q").to_numpy()[i], "vec_id": ids[at[i, j]], "score": far[i, j]})

    keys = ["part", "row_block", "query_block"]
    found = (rows.select("vec_id", "v", *keys).groupBy(*keys)
             .cogroup(questions.select("q", "v", *keys).groupBy(*keys))
             .applyInArrow(rerank, "q long, vec_id long, score double"))
    near = Window.partitionBy("q").orderBy("score", "vec_id")
    best = found.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1)
    lists = best.groupBy("q").agg(F.collect_list(F.struct("score", "vec_id")).alias("near"))  # k + 1 at most
    salts = 16  # a question of very many queries is dealt to so many tasks
    lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    each = (asking.select("query_id", "q", F.pmod(F.xxhash64("query_id"), F.lit(salts)).cast("int").alias("salt"))
            .join(lists, ["q", "salt"])
            .select("query_id", F.slice(F.array_sort(F.filter(
                "near", lambda x: x["vec_id"] != F.col("query_id"))), 1, k).alias("near")))
    return (each.select("query_id", F.posexplode("near").alias("rank", "one"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "one.vec_id", "one.score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
