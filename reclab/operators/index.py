"""Dense integer ids by frequency, as ``StringIndexer(stringOrderType=
"frequencyDesc")`` assigns them (most frequent label = 0, ties by label
ascending), but kept as a mapping table instead of a label array on the
driver: the mapping is computed with a distributed global order, applied
with joins, and written without column metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclab.operators.ordering import global_index

HANDLE_INVALID = ("error", "skip", "keep")


def fit_index(df: DataFrame, col: str) -> DataFrame:
    """Mapping ``(label STRING, idx INT, freq LONG)``; NULL labels are skipped
    (as the ML indexer skips them when fitting)."""
    counts = (df.where(F.col(col).isNotNull())
              .groupBy(F.col(col).cast("string").alias("label"))
              .agg(F.count(F.lit(1)).alias("freq")))
    mapped = global_index(counts, [F.desc("freq"), F.asc("label")], idx_col="idx")
    # the order was written once; every split that joins the mapping rereads it
    return mapped.select("label", F.col("idx").cast("int").alias("idx"), "freq")


def apply_index(df: DataFrame, mapping: DataFrame, col: str, out_col: str,
                handle_invalid: str = "error") -> DataFrame:
    """Add ``out_col`` (INT) for ``col``.  ``error`` raises (lazily, like the ML
    indexer) on an unseen or NULL label, ``skip`` drops such rows, ``keep`` maps
    them to ``n_labels``.  The join lets AQE broadcast a mapping that measures
    small and split a skewed label on the big side."""
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"handle_invalid must be one of {HANDLE_INVALID}")
    m = mapping.select(F.col("label").alias("_lbl"), F.col("idx").alias(out_col))
    key = F.col(col).cast("string")
    if handle_invalid == "skip":
        return df.join(m, key == F.col("_lbl"), "inner").drop("_lbl")
    joined = df.join(m, key == F.col("_lbl"), "left").drop("_lbl")
    if handle_invalid == "error":
        msg = F.concat(F.lit(f"unseen label in column {col}: "),
                       F.coalesce(key, F.lit("NULL")))
        fixed = F.when(F.col(out_col).isNull(), F.raise_error(msg)).otherwise(F.col(out_col))
    else:
        n_labels = mapping.count()
        fixed = F.coalesce(F.col(out_col), F.lit(n_labels))
    return joined.withColumn(out_col, fixed.cast("int"))


def invert_index(df: DataFrame, mapping: DataFrame, idx_col: str, out_col: str) -> DataFrame:
    """Labels back from ids (what ``IndexToString`` does, as a join)."""
    m = mapping.select(F.col("idx").alias("_idx"), F.col("label").alias(out_col))
    return df.join(m, F.col(idx_col) == F.col("_idx"), "left").drop("_idx")


def format_triples(df: DataFrame, users: DataFrame, items: DataFrame,
                   handle_invalid: str = "error", user_col: str = "user_id",
                   item_col: str = "track_id", count_col: str = "count") -> DataFrame:
    """``(user INT, item INT, count DOUBLE)`` ready for ALS, without metadata."""
    out = apply_index(df, users, user_col, "user", handle_invalid)
    out = apply_index(out, items, item_col, "item", handle_invalid)
    return out.select(F.col("user").alias("user", metadata={}),
                      F.col("item").alias("item", metadata={}),
                      F.col(count_col).cast("double").alias("count", metadata={}))


def index_splits(train: DataFrame, val: DataFrame, test: DataFrame, fit_on: str = "all",
                 handle_invalid: str = "error", user_col: str = "user_id",
                 item_col: str = "track_id"):
    """Fit user and item mappings and format all three splits.

    ``fit_on``: ``all`` (train+val+test, the reference's final choice),
    ``train`` (both on train), or ``train_items_val`` (users on train, items
    on train+val, as an earlier version did)."""
    both = train.select(user_col, item_col).unionByName(val.select(user_col, item_col))
    every = both.unionByName(test.select(user_col, item_col))
    if fit_on == "all":
        u_src, i_src = every, every
    elif fit_on == "train":
        u_src, i_src = train, train
    elif fit_on == "train_items_val":
        u_src, i_src = train, both
    else:
        raise ValueError("fit_on must be all, train or train_items_val")
    users = fit_index(u_src, user_col)
    items = fit_index(i_src, item_col)
    frames = tuple(format_triples(d, users, items, handle_invalid, user_col, item_col)
                   for d in (train, val, test))
    return users, items, frames
