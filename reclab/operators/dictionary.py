"""A dictionary of dense ids that only grows.

``fit_index`` numbers labels by frequency, so new data would renumber
everything.  Here an id is given once: every batch of data appends one version
with the labels not seen before, numbered after the known ones (by frequency
in the batch, then by label).  Models fitted under an earlier version stay
valid, and any version can be read back.

The dictionary is a folder of commits (see the results log): a version is
staged, renamed in one step, and visible as a whole or not at all.  Two
writers that number the same version cannot both commit it; the later one
numbers its labels again behind the other's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reclab.operators.ordering import global_index
from reclab.sources import io

SCHEMA = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("idx", T.IntegerType()),
    T.StructField("freq", T.LongType()), T.StructField("version", T.IntegerType())])
_ATTEMPTS = 20


def new_labels(known: DataFrame, df: DataFrame, col: str, version: int, first: int) -> DataFrame:
    """(label, idx, freq, version) of the labels of ``df`` not in ``known``,
    numbered from ``first``; null labels get no id."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("label"))
              .agg(F.count(F.lit(1)).alias("freq")).join(known.select("label"), "label", "left_anti"))
    placed = global_index(counts, [F.desc("freq"), F.asc("label")], idx_col="idx")
    return placed.select("label", (F.col("idx") + first).cast("int").alias("idx"), "freq",
                         F.lit(version).cast("int").alias("version"))


class Dictionary:
    """The dictionary in the folder ``path`` (empty or absent: no labels)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def mapping(self, version: int | None = None) -> DataFrame:
        """(label, idx, freq, version) as of ``version`` (default: the latest)."""
        rows = io.read_log(self.spark, self.path, SCHEMA)
        return rows if version is None else rows.where(F.col("version") <= version)

    def state(self) -> tuple[int, int]:
        """The latest version (0: none) and the number of labels."""
        row = self.mapping().agg(F.max("version").alias("v"), F.max("idx").alias("i")).first()
        return row["v"] or 0, -1 if row["i"] is None else row["i"]

    def extend(self, df: DataFrame, col: str) -> int:
        """Append the new labels of ``df`` as the next version and return the
        version that knows them all (the latest one if there are none)."""
        for _ in range(_ATTEMPTS):
            version, last = self.state()
            known = self.mapping().where(F.col("version") <= version)
            rows = new_labels(known, df, col, version + 1, last + 1)
            if rows.isEmpty():
                return version
            if io.commit_rows(rows, self.path, f"version {version + 1}", files=None):
                return version + 1
        raise RuntimeError(f"{self.path}: other writers committed {_ATTEMPTS} versions meanwhile")
