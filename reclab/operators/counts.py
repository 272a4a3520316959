"""Count transforms for implicit ALS (the README's "modification strategies").

``log`` maps 1 to 0, and a 0 rating carries no confidence and no preference
in implicit ALS, so ``log`` also deletes every count-1 row; ``log1p`` keeps
them.  ``log`` of 0 is NULL, which ALS rejects, so non-positive counts are
removed before any transform.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOWS = ("raw", "drop", "log", "log1p", "cap", "binary")


def _value(how: str, c: Column, min_count: int, cap: float | None) -> Column:
    """Transformed value, NULL where the row is removed."""
    pos = c > 0
    if how == "raw":
        v = c.cast("double")
    elif how == "drop":
        return F.when(c >= min_count, c.cast("double"))
    elif how == "log":
        v = F.log(c.cast("double"))
    elif how == "log1p":
        v = F.log1p(c.cast("double"))
    elif how == "cap":
        if cap is None:
            raise ValueError("cap needs a value")
        v = F.least(c.cast("double"), F.lit(float(cap)))
    elif how == "binary":
        v = F.lit(1.0)
    else:
        raise ValueError(f"how must be one of {HOWS}")
    return F.when(pos, v)


def transform_counts(df: DataFrame, how: str = "raw", min_count: int = 2,
                     cap: float | None = None, col: str = "count") -> DataFrame:
    """Rows kept by ``how`` with ``col`` replaced by the transformed double."""
    v = _value(how, F.col(col), min_count, cap)
    return df.withColumn(col, v).where(F.col(col).isNotNull())


def variants_long(df: DataFrame, hows=HOWS, min_count: int = 2, cap: float | None = 10.0,
                  keep_removed: bool = False, cols=("user_id", "track_id"),
                  col: str = "count") -> DataFrame:
    """``(cols..., how, v)``: every strategy's value for every row, from one
    scan (``v`` NULL where the strategy removes the row, unless dropped)."""
    variants = F.array(*[F.struct(F.lit(h).alias("how"),
                                  _value(h, F.col(col), min_count, cap).alias("v"))
                         for h in hows])
    out = df.select(*cols, F.explode(variants).alias("_t")).select(*cols, "_t.how", "_t.v")
    return out if keep_removed else out.where(F.col("v").isNotNull())


def transform_report(df: DataFrame, hows=HOWS, min_count: int = 2, cap: float = 10.0,
                     user_col: str = "user_id", item_col: str = "track_id", col: str = "count",
                     digits: int = 5) -> DataFrame:
    """One row per strategy: rows kept and removed, users and items that keep
    at least one row, rows whose value became 0 (no signal for ALS), and the
    sum/min/max of the values.

    One aggregation gives the sums of all strategies without multiplying rows.
    A strategy removes rows by one of two rules (count > 0, count >=
    min_count), so users and items kept come from two flags per user and per
    item."""
    c = F.col(col)

    def stats(how):
        v = _value(how, c, min_count, cap)
        return F.struct(
            F.lit(how).alias("how"), F.count(v).alias("rows_kept"),
            (F.count(F.lit(1)) - F.count(v)).alias("rows_removed"),
            F.sum((v == 0).cast("long")).alias("rows_zero"), F.round(F.sum(v), digits).alias("value_sum"),
            F.round(F.min(v), digits).alias("value_min"), F.round(F.max(v), digits).alias("value_max"),
            F.lit(how == "drop").alias("by_min"))

    rows = df.agg(F.array(*[stats(h) for h in hows]).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    rules = {True: c >= min_count, False: (c > 0)}

    def kept(key, name):
        flags = df.groupBy(key).agg(*[F.max(F.coalesce(rule, F.lit(False)).cast("int")).alias(f"k{int(b)}")
                                      for b, rule in rules.items()])
        n = flags.agg(F.sum("k1").alias("n1"), F.sum("k0").alias("n0"))
        return n.select(F.explode(F.array(*[F.struct(
            F.lit(b).alias("by_min"), F.coalesce(F.col(f"n{int(b)}"), F.lit(0)).cast("long").alias(name))
            for b in rules])).alias("x")).select("x.*")

    return (rows.join(kept(user_col, "users_kept"), "by_min").join(kept(item_col, "items_kept"), "by_min")
            .select("how", "rows_kept", "rows_removed", "users_kept", "items_kept", "rows_zero",
                    "value_sum", "value_min", "value_max"))


def check_signal(df: DataFrame, col: str = "count") -> dict:
    """Pre-fit check (one aggregation): no rows, NULL/NaN ratings, or nothing
    but zero ratings.  Raises with the cause named instead of letting the
    solver fail later with a singular matrix."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum((F.col(col).isNull() | F.isnan(col)).cast("long")).alias("bad"),
        F.sum((F.col(col) != 0).cast("long")).alias("nonzero"),
    ).first()
    if row["rows"] == 0:
        raise ValueError("no training rows left after the count transform")
    if row["bad"]:
        raise ValueError(f"{row['bad']} ratings are NULL or NaN (log of a count <= 0?)")
    if not row["nonzero"]:
        raise ValueError("every rating is 0: no signal for implicit ALS (log of counts of 1?)")
    return row.asDict()
