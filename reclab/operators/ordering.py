"""Dense positions in a global order without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into
one task.  Here the rows are range-partitioned on the order, sorted inside
each partition, tagged with their partition and in-partition position, and
shifted by the sizes of the partitions before them (a table with one row per
partition, broadcast by construction).  The tagged table is first written
once to the cluster's checkpoint folder and read back: range bounds come
from a sample, so a recomputed partition after an executor loss must not see
different bounds than the offsets were computed from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reclab.session import scratch_path, shuffles_released


def global_index(df: DataFrame, order: list, idx_col: str = "idx",
                 num_partitions: int | None = None, range_col: str | None = None) -> DataFrame:
    """Add ``idx_col`` = 0-based position of each row in ``order``.

    ``order`` must be a total order (add a unique tie-breaker); the result is
    then deterministic and equals ``row_number() over (order by ...) - 1``.
    ``range_col`` keeps the number of the range a row was sorted in."""
    spark = df.sparkSession
    # Without an explicit count AQE may merge small ranges; merged partitions
    # are still contiguous ranges in order, so the offsets stay correct.
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    path = scratch_path(spark, "order")
    with shuffles_released(spark):
        (ranged.sortWithinPartitions(*order)
         .select("*", F.spark_partition_id().alias("_gi_pid"),
                 F.monotonically_increasing_id().alias("_gi_mid"))
         .write.parquet(path))
    tagged = spark.read.parquet(path)
    # one row per range: the only thing that a single task orders
    before = Window.orderBy("_gi_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_gi_pid")
        .agg(F.count(F.lit(1)).alias("_gi_n"), F.min("_gi_mid").alias("_gi_m0"))
        .select("_gi_pid", "_gi_m0",
                F.coalesce(F.sum("_gi_n").over(before), F.lit(0)).alias("_gi_off"))
    )
    kept = [F.col("_gi_pid").alias(range_col)] if range_col else []
    return tagged.join(F.broadcast(offsets), "_gi_pid").select(
        *[F.col(c) for c in df.columns], *kept,
        (F.col("_gi_off") + F.col("_gi_mid") - F.col("_gi_m0")).alias(idx_col),
    )
