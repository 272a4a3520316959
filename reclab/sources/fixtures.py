"""Interaction tables derived from the driver's test data.

The reference's listening counts are replaced by purchase quantities: a
customer is a user, a part is a track, and the count is the summed quantity
of that part over the customer's orders.  Ids are strings (``U<custkey>``,
``T<partkey>``) so the string indexing path is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, track_id, count)``: lineitem joined to orders, summed per pair.

    Plan: both scans pruned to their key/quantity columns, a shuffled join on
    the order key (broadcast only if AQE measures a side under the threshold),
    then a partial + final aggregation on (customer, part)."""
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = li.join(od, li.l_orderkey == od.o_orderkey)
    return (
        pairs.groupBy("o_custkey", "l_partkey")
        .agg(F.round(F.sum("l_quantity")).cast("long").alias("count"))
        .select(
            F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"),
            F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("track_id"),
            "count",
        )
    )


def events_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second, heavily tied fixture: events per (user, ``props.k``)."""
    ev = load_table(spark, sf_dir, "events").select("user_id", "props")
    return (
        ev.select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"),
            F.concat(F.lit("K"), F.get_json_object("props", "$.k")).alias("track_id"),
        )
        .where(F.col("track_id").isNotNull())
        .groupBy("user_id", "track_id")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def item_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item side data (stands in for track metadata), keyed by ``track_id``."""
    p = load_table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("track_id"),
        "p_name", "p_brand", "p_type", "p_size", "p_retailprice",
    )


def user_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load_table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("user_id"),
        "c_mktsegment", "c_nationkey",
    )
