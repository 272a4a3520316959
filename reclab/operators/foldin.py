"""Factors for new users (or items) without a refit.

With the other side's factors fixed, the factor of a key is the solution of a
small linear system, the one that an ALS half-step solves:

    (G + sum c y y' + reg n I) x = sum (1 + c) y      implicit, c = alpha |r|, r > 0
    (sum y y' + reg n I) x = sum r y                  explicit

``G``, the Gramian of all fixed factors, is shared: partial matrices per task
are summed by position, so only rank^2 numbers reach the driver.  The sums of
a key are taken over chunks of at most ``chunk`` of its rows and then over its
chunks, so a key with a large share of all rows is spread.  Rows sorted by key
stream through the tasks: all runs of a batch are summed, and all systems of a
batch solved, by one array operation each, with no call per key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 4096

STEP = 1 << 20  # matrix values of the rows that are summed at a time

_PARTIAL = "id int, n long, matrix binary, vector binary"
_FACTORS = "id int, features array<float>"


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def gramian(factors: DataFrame, features_col: str = "features") -> np.ndarray:
    """``sum y y'`` over all factors (rank x rank)."""
    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                y = _matrix(pa.chunked_array([batch.column(0)]))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["at", "value"])

    sums = (factors.select(F.col(features_col).cast("array<double>").alias("y"))
            .mapInArrow(partial, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")))
    cells = sums.toArrow()  # rank^2 rows
    out = np.zeros(cells.num_rows)
    out[cells.column("at").to_numpy()] = cells.column("value").to_numpy()
    rank = int(round(cells.num_rows**0.5))
    return out.reshape(rank, rank)


def _sums(interactions: DataFrame, factors: DataFrame, key: str, other: str, rating: str, alpha: float,
          implicit: bool, chunk: int) -> DataFrame:
    """(id, n, matrix, vector) partial sums of every chunk of every key."""
    rows = interactions.select(F.col(key).cast("int").alias("id"), F.col(other).cast("int").alias("other"),
                               F.col(rating).cast("double").alias("r"))
    rows = rows.where(F.col("id").isNotNull() & F.col("r").isNotNull() & ~F.isnan("r"))
    # factors join last and as they are: each row carries one through one shuffle only
    known = factors.select(F.col("id").alias("other"), F.col("features").alias("y"))
    sizes = rows.groupBy("id").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    rows = rows.join(sizes, "id").withColumn(
        "chunk", F.pmod(F.xxhash64("other", "r"), F.col("chunks")).cast("int")).join(known, "other")

    def add(batch):
        y, r = _matrix(pa.chunked_array([batch.column(3)])), batch.column(2).to_numpy()
        outer = y[:, :, None] * y[:, None, :]
        if implicit:
            c, liked = alpha * np.abs(r), r > 0
            return liked.astype(np.int64), outer * c[:, None, None], y * np.where(liked, 1.0 + c, 0.0)[:, None]
        return np.ones(len(r), np.int64), outer, y * r[:, None]

    def emit(ids, n, matrix, vector):
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(n, pa.int64()), pa.array([m.tobytes() for m in matrix], pa.binary()),
             pa.array([v.tobytes() for v in vector], pa.binary())], names=["id", "n", "matrix", "vector"])

    return (rows.select("id", "chunk", "r", "y").repartition("id", "chunk").sortWithinPartitions("id", "chunk")
            .mapInArrow(_run_sums(2, lambda batch: len(batch.column(3)[0]), add, emit), _PARTIAL))


def _run_sums(n_keys: int, rank_of, rows, emit):
    """mapInArrow body over rows sorted by their first ``n_keys`` columns: the
    sums of every run of equal keys, of (count, matrix, vector) per row."""
    def run(batches):
        last = None
        for whole in batches:
            if not whole.num_rows:
                continue
            step = max(1, STEP // max(1, rank_of(whole)) ** 2)
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                keys = np.stack([batch.column(j).to_numpy() for j in range(n_keys)], axis=1)
                starts = np.concatenate([[0], np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1])
                sums = [np.add.reduceat(a, starts, axis=0) for a in rows(batch)]
                keys = keys[starts]
                if last is not None:
                    if (last[0][0] == keys[0]).all():
                        for total, before in zip(sums, last[1:], strict=True):
                            total[0] += before[0]
                    else:
                        yield emit(last[0][:, 0], *last[1:])
                if len(keys) > 1:
                    yield emit(keys[:-1, 0], *(a[:-1] for a in sums))
                last = [keys[-1:], *(a[-1:] for a in sums)]
        if last is not None:
            yield emit(last[0][:, 0], *last[1:])
    return run


def _systems(partial: DataFrame, gram: np.ndarray | None, reg: float, solve, schema: str) -> DataFrame:
    """``solve(ids, matrices, vectors)`` over the summed chunks of many keys at a time."""
    def rank_of(batch):
        return len(batch.column(3)[0].as_py()) // 8

    def rows(batch):
        k, rank = batch.num_rows, rank_of(batch)
        return (batch.column(1).to_numpy(), np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(k, rank, rank),
                np.frombuffer(b"".join(batch.column(3).to_pylist())).reshape(k, rank))

    def emit(ids, n, matrix, vector):
        matrix = matrix + reg * n[:, None, None] * np.eye(vector.shape[1])
        return solve(ids, matrix if gram is None else matrix + gram, vector)

    return partial.repartition("id").sortWithinPartitions("id").mapInArrow(_run_sums(1, rank_of, rows, emit), schema)


def fold_in(interactions: DataFrame, factors: DataFrame, reg_param: float, alpha: float = 1.0,
            implicit: bool = True, key: str = "user", other: str = "item", rating: str = "count",
            gram: np.ndarray | None = None, chunk: int = CHUNK) -> DataFrame:
    """``(id, features)`` for every key of ``interactions(key, other, rating)``
    from the fixed ``factors(id, features)`` of the other side.  Swap ``key``
    and ``other`` (and the factors) to fold in items.

    Rows whose other side has no factor, and null ratings, take no part; a key
    without any row left gets no factor.  Repeated (key, other) rows add up as
    in an ALS fit.  ``gram`` saves the pass over ``factors`` when known."""
    if implicit and gram is None:
        gram = gramian(factors)
    partial = _sums(interactions, factors, key, other, rating, alpha, implicit, chunk)

    def solve(ids, matrix, vector):
        try:
            x = np.linalg.solve(matrix, vector[:, :, None])[:, :, 0]
        except np.linalg.LinAlgError:  # reg 0 and dependent factors: the smallest solution
            x = np.stack([_solution(m, v) for m, v in zip(matrix, vector, strict=True)])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))],
            names=["id", "features"])

    return _systems(partial, gram if implicit else None, reg_param, solve, _FACTORS)


def _solution(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(matrix, vector)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(matrix, vector, rcond=None)[0]


def gradients(folded: DataFrame, interactions: DataFrame, factors: DataFrame, reg_param: float,
              alpha: float = 1.0, implicit: bool = True, key: str = "user", other: str = "item",
              rating: str = "count", chunk: int = CHUNK) -> DataFrame:
    """``(id, gradient)``: the largest component of the objective's gradient at
    each folded factor, relative to the size of its right-hand side."""
    gram = gramian(factors) if implicit else None
    partial = _sums(interactions, factors, key, other, rating, alpha, implicit, chunk)

    def keep(ids, matrix, vector):
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array([m.tobytes() for m in matrix], pa.binary()),
             pa.array([v.tobytes() for v in vector], pa.binary())], names=["id", "matrix", "vector"])

    systems = _systems(partial, gram, reg_param, keep, "id int, matrix binary, vector binary")

    def slope(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k, x = batch.num_rows, _matrix(pa.chunked_array([batch.column(1)]))
            v = np.frombuffer(b"".join(batch.column(3).to_pylist())).reshape(k, -1)
            m = np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(k, v.shape[1], -1)
            scale = np.maximum(np.maximum(1.0, np.abs(v).max(axis=1)),
                               np.abs(m).max(axis=(1, 2)) * np.abs(x).max(axis=1))
            out = np.abs(np.einsum("kij,kj->ki", m, x) - v).max(axis=1) / scale
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())],
                                             names=["id", "gradient"])

    return (folded.select("id", "features").join(systems, "id").select("id", "features", "matrix", "vector")
            .mapInArrow(slope, "id int, gradient double"))
