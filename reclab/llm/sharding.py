"""Sharding by histogram sort.

Rows are ordered by (hash of the text, row number), so equal texts lie side by
side and a hot text can still be cut between shards.  The boundaries between
shards are found without sorting: each round counts the exact bytes and rows
below candidate boundary keys in every partition, adds the counts up, and
refines the candidates around each target until a boundary meets its tolerance
or no row is left to place.  Only then does one exchange move the rows.

A shard larger than one task should sort is cut by further boundaries found in
the same rounds, so that a slot (position in the shard) is the exact count of
rows below a range plus the position in that range.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SHARDS = 40
#: A boundary may miss its target by this part of a shard's bytes.
TOLERANCE = 0.001
#: Candidate keys a round tries for each open boundary.
PROBES = 16
#: Bytes that one range of the final exchange should hold (one task sorts it).
RANGE_BYTES = 256 << 20
#: Ranges of all shards together: beyond them ranges grow (a task's sort spills),
#: so that what the driver keeps of the search never grows with the data.
MAX_RANGES = 1 << 14

_KEY, _ROW, _SIZE = "shard_key", "shard_row", "shard_size"
_TOP = 1 << 128


def _split(key: int) -> tuple[int, int]:
    return (key >> 64) - (1 << 63), (key & ((1 << 64) - 1)) - (1 << 63)


def _join(key: int, row: int) -> int:
    return ((key + (1 << 63)) << 64) | (row + (1 << 63))


def _below(keys: np.ndarray, rows: np.ndarray, k: np.ndarray, r: np.ndarray) -> np.ndarray:
    """For each (k, r), how many of the sorted boundaries (keys, rows) are <= it."""
    out = np.searchsorted(keys, k, "left")
    upto = np.searchsorted(keys, k, "right")
    for at in np.unique(out[upto > out]):
        mine = (out == at) & (upto > out)
        hi = np.searchsorted(keys, keys[at], "right")
        out[mine] = at + np.searchsorted(rows[at:hi], r[mine], "right")
    return out


def _bucketed(table: DataFrame, bounds: list[int], name: str) -> DataFrame:
    pairs = [_split(min(b, _TOP - 1)) for b in bounds]
    keys = np.array([p[0] for p in pairs], np.int64)
    rows = np.array([p[1] for p in pairs], np.int64)
    schema = T.StructType([*table.schema.fields, T.StructField(name, T.IntegerType())])
    at, row = table.columns.index(_KEY), table.columns.index(_ROW)

    def run(batches):
        for b in batches:
            if b.num_rows:
                got = _below(keys, rows, b.column(at).to_numpy(), b.column(row).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(got.astype(np.int32))], names=schema.names)

    return table.mapInArrow(run, schema)


def _histogram(table: DataFrame, bounds: list[int]):
    """Bytes, rows, least and greatest key between consecutive boundaries."""
    keyed = _bucketed(table.select(_KEY, _ROW, _SIZE), bounds, "bucket")
    both = F.struct(_KEY, _ROW)
    return {r["bucket"]: (r["b"], r["n"], _join(*r["lo"]), _join(*r["hi"])) for r in keyed.groupBy(
        "bucket").agg(F.sum(_SIZE).alias("b"), F.count(F.lit(1)).alias("n"), F.min(both).alias("lo"),
                      F.max(both).alias("hi")).collect()}  # one row per candidate


def boundaries(table: DataFrame, total: int, count: int, targets: list[tuple[float, float]],
               ) -> list[tuple[int, int, int]]:
    """(key, bytes below it, rows below it) for each (target bytes, tolerance)."""
    lo = [(0, 0, 0)] * len(targets)
    hi = [(_TOP, total, count)] * len(targets)

    def best(i):
        return min(lo[i], hi[i], key=lambda x: abs(x[1] - targets[i][0]))

    first = True
    while True:
        open_ = [i for i, (t, tol) in enumerate(targets)
                 if abs(best(i)[1] - t) > tol and hi[i][2] - lo[i][2] > 1 and hi[i][0] - lo[i][0] > 1]
        if not open_:
            return [best(i) for i in range(len(targets))]
        probes = set()
        if first:
            n = 4 * (len(targets) + 1)
            probes = {_TOP * j // n for j in range(1, n)}
        for i in [] if first else open_:
            a, b = lo[i][0], hi[i][0]
            probes |= {a + (b - a) * j // (PROBES + 1) for j in range(1, PROBES + 1)} - {a, b}
        first = False
        tried = sorted(probes)
        found = _histogram(table, tried)
        marks, b, n = [], 0, 0  # every known (key, bytes below, rows below), ends of gaps included
        for j in range(len(tried) + 1):
            if j:
                marks.append((tried[j - 1], b, n))
            if j in found:
                more_b, more_n, least, most = found[j]
                marks += [(least, b, n), (most + 1, b + more_b, n + more_n)]
                b, n = b + more_b, n + more_n
        marks.sort()
        weights = [m[1] for m in marks]
        for i in open_:
            at = bisect.bisect_right(weights, targets[i][0])
            if at and marks[at - 1][0] > lo[i][0]:
                lo[i] = marks[at - 1]
            if at < len(marks) and marks[at][0] < hi[i][0]:
                hi[i] = marks[at]


def shard(docs: DataFrame, size: Column | str, shards: int = SHARDS, by: Column | None = None,
          tolerance: float = TOLERANCE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` with shard (int, 0 to shards - 1) and slot (long, gapless from 0
    in each shard) added; names already taken get an underscore.

    The law is ``bytes``: the sums of ``size`` (a positive column or
    expression) are equal up to ``tolerance`` of a shard, or to one row where
    rows are larger than that.  ``by`` is the 64-bit sort key (default: the
    hash of ``text``, null a value like others); rows with the same key, and
    repeated rows, are told apart by the number they get when the table is
    written once, so a key holding any share of the rows is cut exactly.  An
    empty table gives an empty result; no text is read or moved in parts, however
    long; with fewer rows than shards some shards
    stay empty.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    by = F.xxhash64("text") if by is None else by
    size = F.col(size) if isinstance(size, str) else size
    shard_name, slot_name = common.free_name(docs, "shard"), common.free_name(docs, "slot")
    # the caller's columns travel in one struct, so that no name can clash
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    table = common.written(docs.select(
        by.cast("long").alias(_KEY), size.cast("long").alias(_SIZE), F.monotonically_increasing_id().alias(_ROW),
        own.alias("own")), "shard-rows")
    all_ = table.agg(F.sum(_SIZE).alias("b"), F.count(F.lit(1)).alias("n")).first()
    total, count = all_["b"] or 0, all_["n"]
    each = total / shards
    parts = max(1, min(-(-int(each) // range_bytes), MAX_RANGES // shards))  # ranges in a shard
    targets = [(each * j / parts, each * (tolerance if j % parts == 0 else 0.05))
               for j in range(1, shards * parts)]
    cuts = boundaries(table, total, count, targets) if count else []
    for i in range(1, len(cuts)):  # targets closer than one row: keep the order
        cuts[i] = max(cuts[i], cuts[i - 1])
    ranged = _bucketed(table, [c[0] for c in cuts], "shard_range")
    starts = [0, *(c[2] for c in cuts)]
    begin = [s - starts[i - i % parts] for i, s in enumerate(starts)]
    # one value per range: an array in the plan, bounded by the number of ranges
    offset = F.element_at(F.lit(np.array(begin, np.int64)), F.col("shard_range") + 1)
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("shard_range").orderBy(_KEY, _ROW))
    return ranged.select("own", F.floor(F.col("shard_range") / parts).cast("int").alias("shard_out"),
                         (offset + place - 1).alias("slot_out")).select(
        "own.*", F.col("shard_out").alias(shard_name), F.col("slot_out").alias(slot_name))


def write_shards(docs: DataFrame, path: str, size: Column | str, **options) -> None:
    """Write ``docs`` as one folder per shard, each file ordered by slot."""
    out = shard(docs, size, **options)
    out.write.partitionBy("shard").parquet(path)


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select(
        "doc_id", (text_bytes() + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("by"))
    return shard(docs, "size", by=F.col("by")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
