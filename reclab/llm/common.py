"""Helpers shared by the corpus operators: tables, scratch copies, Arrow
text buffers, and vectorised rolling hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reclab.session import scratch_path

#: Bytes of text handled in one vectorised step (bounds a task's memory; a
#: longer document is a step of its own).
STEP_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting that removes the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Settings under which only joins that say ``F.broadcast`` broadcast a side.
SHUFFLED_JOINS = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def written(df: DataFrame, name: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: cuts
    lineage, so that a lost executor costs a re-read and not a recomputation.
    The shuffle files of the write go when it has ended; otherwise those of
    all steps would pile up until the driver happens to collect their plans.
    ``settings`` hold for this write only."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    settings = {_CLEANUP: "true", **(settings or {})}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or it with underscores added until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_fold(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the document id written as text (null id: of no text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def append_columns(df: DataFrame, make, fields: list[tuple[str, T.DataType]], text: str = "text",
                   ) -> DataFrame:
    """``df`` with columns added by ``make(array) -> list of Arrow arrays``,
    where ``array`` is a batch of the ``text`` column (nulls kept)."""
    schema = T.StructType(list(df.schema.fields) + [T.StructField(n, t) for n, t in fields])
    at = df.columns.index(text)

    def add(batches):
        for batch in batches:
            if batch.num_rows:
                new = make(batch.column(at))
                yield pa.RecordBatch.from_arrays(
                    list(batch.columns) + list(new), names=[str(i) for i in range(len(schema))]
                ).rename_columns(schema.names)

    return df.mapInArrow(add, schema)


def buffers(array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offsets of its values (null: empty)."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary()).fill_null(b"")
    n = len(array)
    offsets = np.frombuffer(array.buffers()[1], np.int64, n + 1, array.offset * 8)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES):
    """Ranges of consecutive documents of at most ``limit`` bytes each; a
    longer document is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (all bits depend on all bits)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class RollingHash:
    """Polynomial hash modulo 2^64 over a random table of symbol values: with
    prefix sums, the hash of any span costs two look-ups.  Two instances with
    different seeds give 128 bits."""

    def __init__(self, seed: int):
        rng = np.random.RandomState(seed)
        draw = rng.randint(0, 1 << 32, size=(257, 2), dtype=np.uint64)
        words = (draw[:, 0] << np.uint64(32)) | draw[:, 1]
        self.table = words[:256]
        self.base = int(words[256]) | 5  # odd, so it has an inverse
        self.inverse = pow(self.base, -1, 1 << 64)
        self._pow = self._inv = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._pow) < n:
            n = max(n, 2 * len(self._pow))
            for name, b in (("_pow", self.base), ("_inv", self.inverse)):
                out = np.empty(n, np.uint64)
                out[0], filled, step = 1, 1, b
                while filled < n:  # doubling: out[k:2k] = out[:k] * b^k
                    take = min(filled, n - filled)
                    out[filled:filled + take] = out[:take] * np.uint64(step)
                    filled, step = filled + take, step * step & _MASK
                setattr(self, name, out)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self._pow[:len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._powers(int(starts.max(initial=0)) + 1)
        return mix((prefix[ends] - prefix[starts]) * self._inv[starts])

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """Hash of every span of ``width`` symbols, by start."""
        n = len(prefix) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((prefix[width:] - prefix[:n]) * self._inv[:n])


#: The white space of the contracts: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def runs(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of equal non-zero ``kind`` that cross no document border:
    their starts, ends, and the document of each."""
    n = len(kind)
    cut = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:n]) if n else None
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    keep = kind[starts] != 0 if n else np.zeros(len(starts), bool)
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1
