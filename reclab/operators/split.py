"""User sets, samples, hold-out splits and audits.

Id sets never travel through the driver: set difference is a left-anti join,
membership a left-semi join, union a ``unionByName`` + ``distinct``.
Samples are exact-size and deterministic: the ``n`` users with the smallest
``md5(salt || user)``, which an SQL engine can reproduce; a histogram of hash
prefixes finds the boundary, so users are filtered and never sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclab.functions.hashing import bucket
from reclab.operators.selection import smallest

SPLITS = ("train", "val", "test")


def distinct_users(df: DataFrame, user_col: str = "user_id") -> DataFrame:
    return df.select(user_col).distinct()


def users_only_in(df: DataFrame, *others: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Users of ``df`` that appear in none of ``others`` (``set(a) - set(b) - ...``)."""
    users = distinct_users(df, user_col)
    for o in others:
        users = users.join(distinct_users(o, user_col), user_col, "left_anti")
    return users


def union_users(*dfs: DataFrame, user_col: str = "user_id") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [d.select(user_col) for d in dfs]).distinct()


def sample_size(n_total: int, fraction: float) -> int:
    """Python's ``round`` (half to even), as the reference's ``sample`` call used."""
    return int(round(n_total * fraction))


def sample_users(users: DataFrame, fraction: float | None = None, n: int | None = None,
                 salt: str = "", user_col: str = "user_id") -> DataFrame:
    """Exactly ``n`` (or ``round(fraction * |users|)``) users: those first in
    ``(md5(salt || user), user)`` order.  ``users`` must hold distinct ids."""
    key = F.md5(F.concat(F.lit(salt), F.col(user_col).cast("string")))
    return smallest(users.select(user_col), key, user_col, n=n, fraction=fraction)


def filter_users(df: DataFrame, users: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Rows of ``df`` whose user is in ``users`` (a semi join, never an IN list)."""
    return df.join(users.select(user_col), user_col, "left_semi")


def subsample(train: DataFrame, val: DataFrame, test: DataFrame, fraction: float = 0.2,
              salt: str = "", user_col: str = "user_id") -> DataFrame:
    """Train rows of all held-out users plus those of a ``fraction`` of the
    train-only users (one parameter; 0.2 is what the reference executed)."""
    only = users_only_in(train, val, test, user_col=user_col)
    kept = union_users(sample_users(only, fraction=fraction, salt=salt, user_col=user_col),
                       val, test, user_col=user_col)
    return filter_users(train, kept, user_col)


def subsample_splits(train: DataFrame, val: DataFrame, test: DataFrame, n_train: int,
                     n_val: int, n_test: int, salt: str = "", user_col: str = "user_id"):
    """Fixed-size user samples of every split.  Train keeps the sampled
    train-only users and the sampled held-out users; val/test keep theirs."""
    only = users_only_in(train, val, test, user_col=user_col)
    s_train = sample_users(only, n=n_train, salt=salt, user_col=user_col)
    s_val = sample_users(distinct_users(val, user_col), n=n_val, salt=salt, user_col=user_col)
    s_test = sample_users(distinct_users(test, user_col), n=n_test, salt=salt, user_col=user_col)
    kept = union_users(s_train, s_val, s_test, user_col=user_col)
    return (filter_users(train, kept, user_col), filter_users(val, s_val, user_col),
            filter_users(test, s_test, user_col))


def holdout(df: DataFrame, val_buckets=(0,), test_buckets=(1, 2), n_buckets: int = 10,
            row_buckets: int = 2, user_col: str = "user_id", item_col: str = "track_id") -> DataFrame:
    """Add ``split``: a user's bucket picks val/test candidates, a row bucket
    keeps part of each held-out user's history in train (as the data set the
    reference was given: full histories plus partial ones)."""
    b = bucket(n_buckets, user_col)
    r = bucket(row_buckets, user_col, item_col)
    split = (F.when(b.isin(*val_buckets) & (r == 0), F.lit("val"))
             .when(b.isin(*test_buckets) & (r == 0), F.lit("test"))
             .otherwise(F.lit("train")))
    return df.withColumn("split", split)


def split_frames(df_with_split: DataFrame):
    cols = [c for c in df_with_split.columns if c != "split"]
    return tuple(df_with_split.where(F.col("split") == s).select(*cols) for s in SPLITS)


def union_splits(*dfs: DataFrame, names=SPLITS) -> DataFrame:
    """Union by column name (a positional union silently mixes columns when the
    splits list them in different orders), tagging each row with its split."""
    first = dfs[0].columns
    for d in dfs[1:]:
        if sorted(d.columns) != sorted(first):
            raise ValueError(f"split columns differ: {first} vs {d.columns}")
    tagged = [d.withColumn("split", F.lit(n)) for d, n in zip(dfs, names)]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def audit(df_with_split: DataFrame, user_col: str = "user_id", item_col: str = "track_id") -> DataFrame:
    """Per split: rows, users, items, and users shared with the other held-out
    split (must be 0).  One aggregation, no driver-side sets."""
    per_user = (df_with_split.groupBy(user_col)
                .agg(F.max((F.col("split") == "val").cast("int")).alias("_in_val"),
                     F.max((F.col("split") == "test").cast("int")).alias("_in_test")))
    shared = per_user.where((F.col("_in_val") == 1) & (F.col("_in_test") == 1))
    shared_n = shared.select(F.count(F.lit(1)).alias("n_users_val_and_test"))
    stats = (df_with_split.groupBy("split")
             .agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct(user_col).alias("n_users"),
                  F.countDistinct(item_col).alias("n_items")))
    # one-row table joined on a constant key, not a cross join
    return (stats.withColumn("_k", F.lit(1))
            .join(shared_n.withColumn("_k", F.lit(1)), "_k").drop("_k"))


def describe(df: DataFrame, col: str = "count", group_col: str | None = None,
             digits: int = 5) -> DataFrame:
    """``describe()`` as typed columns: count, mean, sample stddev, min, max."""
    aggs = [F.count(col).alias("n"),
            F.round(F.avg(col), digits).alias("mean"),
            F.round(F.stddev_samp(col), digits).alias("stddev"),
            F.min(col).alias("min"), F.max(col).alias("max")]
    return df.groupBy(group_col).agg(*aggs) if group_col else df.agg(*aggs)


def describe_columns(df: DataFrame, digits: int = 5) -> DataFrame:
    """``describe()`` of every column, one row each: count, mean and sample
    stddev (NULL for strings), min and max as text.  One aggregation."""
    def stats(field):
        number = field.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")
        none = F.lit(None).cast("double")
        return F.struct(
            F.lit(field.name).alias("column"), F.count(field.name).alias("n"),
            (F.round(F.avg(field.name), digits) if number else none).alias("mean"),
            (F.round(F.stddev_samp(field.name), digits) if number else none).alias("stddev"),
            F.min(field.name).cast("string").alias("min"), F.max(field.name).cast("string").alias("max"))

    rows = df.agg(F.array(*[stats(f) for f in df.schema.fields]).alias("s"))
    return rows.select(F.explode("s").alias("s")).select("s.*")
