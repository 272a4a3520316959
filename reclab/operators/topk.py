"""Exact top-k by inner product, streamed: a chunk of queries stays in a task
while the items it may meet pass by in small cells.

Queries are dealt into chunks whose state (vectors and the best ``k`` so far)
has a bounded size; every chunk reads the item cells once.  Queries are sent
once, items once per chunk, and a task never holds more than its chunk and one
batch of cells.  The chunks run in waves of two for each core, each of which
sends the items to its own chunks only and releases them when it ends: what is
on disk at a time grows with items x cores, not with items x queries.  Only the
final ``k`` rows of a query leave its task.

Where no labels are given the longest items pass first.  A query whose length
times that of the longest item of a tile stays below its k-th best score so far
is not scored against the tile (Cauchy-Schwarz), which changes no result.

A *selector* may name the queries of a chunk that visit a label (a cluster, a
bucket); the other queries are not scored against its cells.
"""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclab.functions.vectors import dot
from reclab.session import materialise, scratch_path, shuffles_released

CHUNK_BYTES = 96 << 20    # vectors, best lists and visits of a chunk of queries
MAX_CHUNK = 1 << 18       # queries of a chunk
CELL_BYTES = 2048         # vectors of a cell: a batch of 10,000 cells stays below 25 MB
RUN_CELLS = 1024          # cells that a task unpacks at a time
TILE = 1 << 21            # scores computed at a time

CELL_SCHEMA = "key string, kind int, label long, ids binary, vals binary, aux binary"
LIST_SCHEMA = "qid long, ids array<long>, scores array<double>"
HIT_SCHEMA = "qid long, ids array<long>, places array<int>"
QUERY, SKIP, MARK, ITEM = 0, 1, 2, 3


def chunk_rows(dims: int, k: int, extra: int = 0, entry: int = 24) -> int:
    """Queries of a chunk: as many as ``CHUNK_BYTES`` hold, ``extra`` bytes each and
    ``entry`` bytes for each of the 2 ``k`` places of a list."""
    return max(64, min(MAX_CHUNK, CHUNK_BYTES // (8 * dims + 2 * entry * k + extra + 64)))


def n_chunks(queries: DataFrame, rows: int) -> int:
    """Chunks of at most ``rows`` queries, and two for each core while they hold
    256 queries or more; as many for each core where they take several waves."""
    n = queries.count()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    least = max(1, math.ceil(n / rows), min(2 * cores, math.ceil(n / 256)))
    return least if least <= 2 * cores else math.ceil(least / cores) * cores


def matrix(column, dtype=np.float64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1)


def cells(df: DataFrame, dtype: str = "f8") -> DataFrame:
    """``df(key string, kind int, label long, id long, v array, aux array)`` with
    the rows of a batch that share key, kind and label packed together."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column(0).dictionary_encode()
            names, code = key.dictionary.to_pylist(), key.indices.to_numpy()
            kind, label, ids = (batch.column(j).to_numpy() for j in (1, 2, 3))
            v, aux = matrix(batch.column(4), dtype), matrix(batch.column(5))
            order = np.lexsort((label, kind, code))
            code, kind, label, ids, v, aux = (a[order] for a in (code, kind, label, ids, v, aux))
            new = (np.diff(code) != 0) | (np.diff(kind) != 0) | (np.diff(label) != 0)
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            most = max(1, CELL_BYTES // max(8, v.itemsize * v.shape[1]))
            ends = np.concatenate([starts[1:], [n]])
            cuts = [(i, min(i + most, e)) for s, e in zip(starts, ends, strict=True) for i in range(s, e, most)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[code[i]] for i, _ in cuts], pa.string()), pa.array([int(kind[i]) for i, _ in cuts], pa.int32()),
                 pa.array([int(label[i]) for i, _ in cuts], pa.int64()),
                 *(pa.array([x[i:j].tobytes() for i, j in cuts], pa.binary()) for x in (ids, v, aux))],
                names=["key", "kind", "label", "ids", "vals", "aux"])

    return df.mapInArrow(run, CELL_SCHEMA)


def runs(batches):
    """``(key, kind, labels, ids, vals, aux)`` of each run of cells (at most
    ``RUN_CELLS``) with one key and kind; labels per row, the last two as flat arrays of bytes."""
    for batch in batches:
        keys, kinds, labels = (batch.column(j).to_pylist() for j in range(3))
        at = 0
        for (key, kind), part in groupby(zip(keys, kinds, strict=True)):
            end = at + sum(1 for _ in part)
            while at < end:
                n = min(RUN_CELLS, end - at)
                ids, vals, aux = (batch.column(j).slice(at, n).to_pylist() for j in (3, 4, 5))
                each = np.repeat(np.array(labels[at:at + n], np.int64), [len(x) // 8 for x in ids])
                yield key, kind, each, np.frombuffer(b"".join(ids), np.int64), b"".join(vals), b"".join(aux)
                at += n


def rounded(scores, digits: int | None):
    """Half away from zero, as SQL rounds."""
    if digits is None:
        return scores
    unit = 10.0 ** digits
    return np.sign(scores) * np.floor(np.abs(scores) * unit + 0.5) / unit


def _lengths(x) -> np.ndarray:
    x = x.astype(np.float64)
    return np.sqrt((x * x).sum(axis=1))


class Chunk:
    """Queries of one chunk with the best ``k`` items met so far, ordered by
    (rounded) score, then smaller id."""

    def __init__(self, ids, q, aux, k: int, digits, exclude_self: bool):
        self.ids, self.q, self.aux, self.k, self.digits, self.exclude_self = ids, q, aux, k, digits, exclude_self
        n, self.width = len(ids), 2 * k
        self.key = np.full((n, self.width), -np.inf, q.dtype if digits is None else np.float64)
        self.score = self.key if digits is None else self.key.copy()
        self.id = np.full((n, self.width), np.iinfo(np.int64).max, np.int64)
        self.fill = np.zeros(n, np.int64)
        self.least = np.full(n, -np.inf)                           # key of the k-th best
        self.least_id = np.full(n, np.iinfo(np.int64).max)         # and its id
        self.skip = self.mark = np.empty(0, np.int64), np.empty(0, np.int64)
        self.mark_first = np.zeros(n + 1, np.int64)
        self.half = 0.0 if digits is None else 0.5 * 10.0 ** -digits
        # lengths of the queries, a little above what rounding of a score can hide
        self.size = _lengths(q) * (1.0 + 4.0 * max(1, q.shape[1]) * np.finfo(q.dtype).eps)

    def _pairs(self, known, qids, items):
        """``known`` pairs (row, item) and those of (query, item), sorted, and
        where each row's begin.  A query id that repeats has them in all its rows."""
        order = np.argsort(self.ids, kind="stable")
        lo, hi = (np.searchsorted(self.ids[order], qids, side) for side in ("left", "right"))
        n = hi - lo
        row = order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        row, items = np.concatenate([known[0], row]), np.concatenate([known[1], np.repeat(items, n)])
        by = np.lexsort((items, row))
        return (row[by], items[by]), np.searchsorted(row[by], np.arange(len(self.ids) + 1))

    def skip_pairs(self, qids, items):
        """Pairs (query, item) that may not be found."""
        self.skip, self.first = self._pairs(self.skip, qids, items)

    def mark_pairs(self, qids, items):
        """Pairs (query, item) whose places are asked for."""
        self.mark, self.mark_first = self._pairs(self.mark, qids, items)

    @staticmethod
    def _among(pairs, first, row, ids):
        """Which candidates are among the pairs: a binary search in each row's own
        sorted items."""
        lo, hi = first[row].copy(), first[row + 1]
        end, items = hi.copy(), pairs[1]
        hi = hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            below = np.zeros(len(lo), bool)
            below[open_] = items[mid[open_]] < ids[open_]
            lo, hi = np.where(open_ & below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
        hit = lo < end
        hit[hit] = items[lo[hit]] == ids[hit]
        return hit

    def _compact(self, rows):
        k = self.k
        order = np.lexsort((self.id[rows], -self.key[rows]), axis=1)[:, :k]
        names = ("key", "id") if self.score is self.key else ("key", "id", "score")
        for name in names:
            a = getattr(self, name)
            kept = np.take_along_axis(a[rows], order, axis=1)
            a[rows] = np.iinfo(np.int64).max if name == "id" else -np.inf
            a[rows[:, None], np.arange(k)[None, :]] = kept
        self.fill[rows] = np.minimum(self.fill[rows], k)
        full = rows[self.fill[rows] >= k]
        self.least[full], self.least_id[full] = self.key[full, k - 1], self.id[full, k - 1]

    def meet(self, rows, ids, x, drop=None):
        """Score the queries ``rows`` against items ``ids``, ``x``; ``drop(rows,
        columns)`` marks candidates that do not count."""
        n_items = max(64, min(8192, len(ids)))
        n_rows = max(1, TILE // n_items)
        for b in range(0, len(ids), n_items):
            near = self._near(rows, x[b:b + n_items])
            for a in range(0, len(near), n_rows):
                part = near[a:a + n_rows]
                self._tile(part, self.q[part], ids[b:b + n_items], x[b:b + n_items],
                           None if drop is None else (lambda r, c, b=b: drop(r, c + b)))

    def _floor(self, rows):
        """A little below what rounding can lift to the k-th best."""
        return self.least[rows] - self.half * (1 + 1e-6)

    def _near(self, rows, x):
        """The queries that an item of ``x`` could still be found for: no score
        exceeds the product of both lengths."""
        if not len(x) or np.isneginf(self.least[rows]).all():
            return rows
        with np.errstate(invalid="ignore"):
            return rows[~(self.size[rows] * _lengths(x).max() < self._floor(rows))]

    def _tile(self, part, q, ids, x, drop):
        k, scores = self.k, q @ x.T
        half, floor = self.half, self._floor(part)
        if half:
            floor = np.where(floor < 0, floor * (1 + 1e-12), floor * (1 - 1e-12))
        # as many of this tile alone as surely hold k that count
        most = k + 1 + (int((self.first[part + 1] - self.first[part]).max()) if len(self.skip[0]) else 0)
        if drop is None and len(ids) > 2 * most and np.isneginf(floor).any():
            kth = np.partition(scores, len(ids) - most, axis=1)[:, len(ids) - most]
            floor = np.maximum(floor, np.where(np.isfinite(kth), kth, -np.inf).astype(np.float64) - 2 * half * (1 + 1e-6))
        r, c = np.divmod(np.flatnonzero(scores >= floor.astype(scores.dtype)[:, None]), len(ids))
        if not len(r):
            return
        value = scores[r, c]
        key, row, found = rounded(value, self.digits), part[r], ids[c]
        keep = np.isfinite(value) & ((key > self.least[row]) | ((key == self.least[row]) & (found < self.least_id[row])))
        if self.exclude_self:
            keep &= found != self.ids[row]
        r, c, value, key, row, found = (z[keep] for z in (r, c, value, key, row, found))
        gone = np.zeros(len(r), bool)
        if drop is not None and len(r):
            gone |= drop(row, c)
        if len(self.skip[0]) and len(r):
            gone |= self._among(self.skip, self.first, row, found)
        if gone.any():
            r, value, key, row, found = (z[~gone] for z in (r, value, key, row, found))
        if not len(r):
            return
        n = np.bincount(r, minlength=len(part))
        if n.max() > k:
            order = np.lexsort((found, -key, r))
            r, value, key, row, found = (z[order] for z in (r, value, key, row, found))
            kept = np.arange(len(r)) - (np.cumsum(n) - n)[r] < k
            r, value, key, row, found = (z[kept] for z in (r, value, key, row, found))
            n = np.minimum(n, k)
        over = self.fill[part] + n > self.width
        if over.any():
            self._compact(part[over])
        at = self.fill[row] + np.arange(len(r)) - (np.cumsum(n) - n)[r]
        self.key[row, at], self.id[row, at] = key, found
        if self.score is not self.key:
            self.score[row, at] = value
        self.fill[part] += n
        # floors tighten once k are known, whenever the lists are half full again
        late = part[(self.fill[part] >= k) & np.isneginf(self.least[part])]
        if len(late):
            self._compact(late)

    def result(self, size: int = 1024):
        """Record batches of the lists, best first."""
        for lo in range(0, len(self.ids), size):
            rows = np.arange(lo, min(lo + size, len(self.ids)))
            self._compact(rows)
            n = self.fill[rows]
            inside = np.arange(self.k)[None, :] < n[:, None]
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[rows]), pa.ListArray.from_arrays(offsets, pa.array(self.id[rows, :self.k][inside])),
                 pa.ListArray.from_arrays(offsets, pa.array(self.score[rows, :self.k][inside].astype(np.float64)))],
                names=["qid", "ids", "scores"])

    def hits(self, size: int = 1024):
        """Record batches of the marked items of the lists and their places from 0."""
        for lo in range(0, len(self.ids), size):
            rows = np.arange(lo, min(lo + size, len(self.ids)))
            self._compact(rows)
            r, place = np.nonzero(np.arange(self.k)[None, :] < self.fill[rows][:, None])
            found = self.id[rows[r], place]
            hit = self._among(self.mark, self.mark_first, rows[r], found)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(r[hit], minlength=len(rows)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[rows]), pa.ListArray.from_arrays(offsets, pa.array(found[hit])),
                 pa.ListArray.from_arrays(offsets, pa.array(place[hit].astype(np.int32)))],
                names=["qid", "ids", "places"])


def _search(k, digits, exclude_self, dtype, selector, hits=False):
    """mapInArrow body over sorted cells: queries of a key, skipped and marked
    pairs, items."""
    def run(batches):
        key = chunk = pick = None
        held: list = []

        def ready():
            aux = np.frombuffer(b"".join(h[2] for h in held), np.float64)
            ids = np.concatenate([h[0] for h in held])
            q = np.frombuffer(b"".join(h[1] for h in held), dtype).reshape(len(ids), -1)
            return Chunk(ids, q, aux.reshape(len(ids), -1), k, digits, exclude_self)

        for name, kind, labels, ids, vals, aux in runs(batches):
            if name != key:
                if held and chunk is None:
                    chunk = ready()
                if chunk is not None:
                    yield from chunk.hits() if hits else chunk.result()
                key, chunk, pick, held = name, None, None, []
            if kind == QUERY:
                held.append((ids, vals, aux))
                continue
            if chunk is None:
                if not held:
                    continue
                chunk, held = ready(), []
                pick = selector(chunk) if selector else None
            if kind in (SKIP, MARK):
                add = chunk.skip_pairs if kind == SKIP else chunk.mark_pairs
                add(ids, np.frombuffer(aux, np.float64).astype(np.int64))
                continue
            x = np.frombuffer(vals, dtype).reshape(len(ids), -1)
            if pick is None:
                chunk.meet(np.arange(len(chunk.ids)), ids, x)
                continue
            extra = np.frombuffer(aux, np.float64).reshape(len(ids), -1)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                rows, drop = pick(int(labels[lo]), extra[lo:hi])
                if len(rows):
                    chunk.meet(rows, ids[lo:hi], x[lo:hi], drop)
        if held and chunk is None:
            chunk = ready()
        if chunk is not None:
            yield from chunk.hits() if hits else chunk.result()
    return run


def search_sorted(rows: DataFrame, k: int, digits: int | None = None, exclude_self: bool = False,
                  dtype: str = "f8", selector=None, hits: bool = False) -> DataFrame:
    """``(qid, ids, scores)`` from cells that are dealt by key, or with ``hits``
    ``(qid, ids, places)`` of the marked items."""
    return (rows.sortWithinPartitions("key", "kind", "label")
            .mapInArrow(_search(k, digits, exclude_self, dtype, selector, hits), HIT_SCHEMA if hits else LIST_SCHEMA))


def by_length(v: str):
    """Labels in whose order the longest vectors come first, in steps of a
    sixteenth of a power of two."""
    return F.coalesce(F.floor(-8 * F.log2(F.greatest(dot(v, v), F.lit(1e-300)))), F.lit(0)).cast("long")


def streamed_topk(queries: DataFrame, items: DataFrame, k: int, dims: int, digits: int | None = None,
                  exclude_self: bool = False, dtype: str = "f8", selector=None, extra: int = 0,
                  skip: DataFrame | None = None, mark: DataFrame | None = None) -> DataFrame:
    """``(qid, ids, scores)``: the best ``k`` items of every query, one row each.

    ``queries(qid, q[, aux])`` and ``items(id, v[, label, aux])``; ``selector``
    turns a chunk into a function of (label, aux of its items) that gives the
    rows to score and a test for candidates to drop; ``skip(qid, id)`` pairs are
    not found.  With ``mark(qid, id)`` only the marked items of a list leave its
    task, with their places from 0: ``(qid, ids, places)``."""
    entry = 12 if dtype == "f4" and digits is None else 16 if digits is None else 24
    n = n_chunks(queries, chunk_rows(dims, k, extra, entry))
    wave = 2 * queries.sparkSession.sparkContext.defaultParallelism
    none = F.array().cast("array<double>")

    def col(df, name, other):
        return F.col(name) if name in df.columns else other

    def chunk(c):
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("string")

    left = cells(queries.select(
        chunk("qid").alias("key"), F.lit(QUERY).alias("kind"), F.lit(0).cast("long").alias("label"),
        F.col("qid").cast("long").alias("id"), F.col("q").alias("v"), col(queries, "aux", none).alias("aux")), dtype)
    if "label" not in items.columns:
        items = items.withColumn("label", by_length("v"))
    right = cells(items.select(
        F.lit("").alias("key"), F.lit(ITEM).alias("kind"), F.col("label").cast("long").alias("label"),
        F.col("id").cast("long").alias("id"), "v", col(items, "aux", none).alias("aux"))
        .sortWithinPartitions("label"), dtype)
    for kind, pairs in ((SKIP, skip), (MARK, mark)):
        if pairs is not None:
            left = left.unionByName(cells(pairs.select(
                chunk("qid").alias("key"), F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("label"),
                F.col("qid").cast("long").alias("id"), none.alias("v"),
                F.array(F.col("id").cast("double")).alias("aux"))))

    def lists(left, right, lo, hi):
        to_each = right.withColumn("key", F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(hi - lo - 1)), lambda i: i.cast("string"))))
        number = F.col("key").cast("int")
        own = left if hi - lo == n else left.where((number >= lo) & (number < hi)).withColumn(
            "key", (number - lo).cast("string"))
        return search_sorted(own.unionByName(to_each).repartitionById(hi - lo, number), k, digits, exclude_self, dtype,
                             selector, mark is not None)

    if n <= wave:
        return lists(left, right, 0, n)
    spark = queries.sparkSession
    left, right = materialise(left, "queries"), materialise(right, "items")
    path = scratch_path(spark, "lists")
    for lo in range(0, n, wave):
        with shuffles_released(spark):
            lists(left, right, lo, min(n, lo + wave)).write.mode("append").parquet(path)
    return spark.read.schema(LIST_SCHEMA if mark is None else HIT_SCHEMA).parquet(path)


class Visits:
    """Which queries of a chunk visit which label, as bits."""

    def __init__(self, n: int, labels: int, mask):
        """``mask(lo, hi)``: the visits of the queries lo..hi-1 as booleans."""
        self.n = n
        self.bits = np.zeros((labels, (n + 7) // 8), np.uint8)
        step = max(8, min(4096, (4 << 20) // max(1, labels)) // 8 * 8)
        for lo in range(0, n, step):
            part = np.packbits(mask(lo, min(n, lo + step)).T, axis=1)
            self.bits[:, lo // 8:lo // 8 + part.shape[1]] = part

    def rows(self, label: int) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.bits[label], count=self.n))


def cheapest(cost: np.ndarray, budget: int) -> np.ndarray:
    """The ``budget`` smallest of each row as booleans, ties to the left; infinite
    costs never count."""
    real = np.isfinite(cost)
    if budget >= cost.shape[1]:
        return real
    if budget < 1:
        return np.zeros_like(real)
    last = np.partition(cost, budget - 1, axis=1)[:, budget - 1:budget]
    below, equal = cost < last, cost == last
    room = budget - below.sum(axis=1, keepdims=True)
    return real & (below | (equal & (np.cumsum(equal, axis=1) <= room)))


def rows_of(lists: DataFrame) -> DataFrame:
    """``(qid, id, score)`` from the lists."""
    return lists.select("qid", F.explode(F.arrays_zip("ids", "scores")).alias("r")).select(
        "qid", F.col("r.ids").alias("id"), F.col("r.scores").alias("score"))
