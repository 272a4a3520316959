"""Error analysis by item group, and a low-dimensional layout of factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def error_by_group(recs: DataFrame, labels: DataFrame, side: DataFrame, group_col: str,
                   item_col: str = "item", user_col: str = "user", digits: int = 5) -> DataFrame:
    """Per group of items: recommended slots, label rows, hits; the group's
    share of recommendations and of labels, their ratio (over/under-
    representation) and the hit rate of its label rows.

    ``kind`` tells a ``group`` row from the ``unknown`` one (items without side
    data or with a NULL group) and the ``total``; the group column is NULL in
    both.  An item may carry several groups (tags): it counts in each, and the
    total counts slots and labels once per tag.  ``recs`` is long per user
    ``(user, pos, item)`` or one global list ``(pos, item)``."""
    g = side.select(F.col(item_col), F.col(group_col).cast("string").alias("grp"))
    lab = labels.select(user_col, item_col).distinct()
    keys = [user_col, item_col] if user_col in recs.columns else [item_col]
    hits = lab.join(recs.select(*keys), keys)

    def counts(df, name):
        # counted by item first: what is joined to the groups is a row per item
        per_item = df.groupBy(item_col).agg(F.count(F.lit(1)).alias("_n"))
        return per_item.join(g, item_col, "left").rollup("grp").agg(
            F.grouping("grp").alias("total"), F.sum("_n").alias(name))

    def same(a, b):
        return a["grp"].eqNullSafe(b["grp"]) & (a["total"] == b["total"])

    a, b, c = counts(lab, "n_label_rows"), counts(recs.select(*keys), "n_rec_slots"), counts(hits, "n_hits")
    out = a.join(b, same(a, b), "full").select(
        F.coalesce(a["grp"], b["grp"]).alias("grp"), F.coalesce(a["total"], b["total"]).alias("total"),
        "n_label_rows", "n_rec_slots")
    out = out.join(c, same(out, c), "left").select(out["grp"], out["total"], "n_label_rows", "n_rec_slots", "n_hits")
    out = out.fillna(0, ["n_label_rows", "n_rec_slots", "n_hits"])
    sums = out.where("total = 1").select(F.lit(0).alias("_k"), F.col("n_label_rows").alias("_tl"),
                                         F.col("n_rec_slots").alias("_tr"))
    out = out.withColumn("_k", F.lit(0)).join(F.broadcast(sums), "_k")  # one row
    rec_share = F.col("n_rec_slots") / F.col("_tr")
    lab_share = F.col("n_label_rows") / F.col("_tl")
    return out.select(
        F.col("grp").alias(group_col),
        F.when(F.col("total") == 1, "total").when(F.col("grp").isNull(), "unknown").otherwise("group").alias("kind"),
        "n_rec_slots", "n_label_rows", "n_hits",
        F.round(rec_share, digits).alias("rec_share"),
        F.round(lab_share, digits).alias("label_share"),
        F.round(F.when(lab_share > 0, rec_share / lab_share), digits).alias("share_ratio"),
        F.round(F.when(F.col("n_label_rows") > 0, F.col("n_hits") / F.col("n_label_rows")),
                digits).alias("hit_rate"))


def factor_layout(factors: DataFrame, side: DataFrame, dims: int = 2, id_col: str = "id",
                  group_col: str | None = None):
    """Project factors to ``dims`` principal components (Spark ML PCA) and join
    side data: ``(id, x0, x1, ..., side columns)``.  With ``group_col`` also a
    per-group centroid table."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = factors.select(id_col, array_to_vector(F.col("features").cast("array<double>")).alias("f"))
    pca = PCA(k=dims, inputCol="f", outputCol="p").fit(v)
    pts = pca.transform(v).select(id_col, vector_to_array("p").alias("p"))
    pts = pts.select(id_col, *[F.col("p")[i].alias(f"x{i}") for i in range(dims)])
    layout = pts.join(side, id_col, "left")
    if group_col is None:
        return layout
    cents = layout.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_items"),
        *[F.avg(f"x{i}").alias(f"c{i}") for i in range(dims)])
    return layout, cents
