"""Shared derivations for the registered queries: the interaction fixture,
its hold-out split and the indexed (formatted) splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reclab.operators import index as ix
from reclab.operators import split as sp
from reclab.session import materialise
from reclab.sources.fixtures import interactions


_SPLIT: dict = {}


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split interaction table, written once per session and data in
    shared storage: every query that derives from it (splits, index fits,
    labels, models) scans that table, with column and filter pushdown, instead
    of re-running the join and aggregation or holding a copy on executors."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SPLIT:
        _SPLIT[key] = materialise(sp.holdout(interactions(spark, sf_dir)), "split")
    return _SPLIT[key]


def splits(spark: SparkSession, sf_dir: str):
    return sp.split_frames(split_table(spark, sf_dir))


_FORMATTED: dict = {}


def formatted(spark: SparkSession, sf_dir: str, fit_on: str = "all"):
    """(users_map, items_map, (train, val, test)) with dense int ids; the two
    maps are tables that are fitted and written once per session and data."""
    key = (spark.sparkContext.applicationId, sf_dir, fit_on)
    if key not in _FORMATTED:
        train, val, test = splits(spark, sf_dir)
        _FORMATTED[key] = ix.index_splits(train, val, test, fit_on=fit_on)
    return _FORMATTED[key]


def string_labels(df: DataFrame) -> DataFrame:
    """Rename raw ids to the (user, item) names the metric operators use."""
    return df.select(F.col("user_id").alias("user"), F.col("track_id").alias("item"), "count")
