"""Dense ids: frequency order, ties, NULL/unseen policies, metadata."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reclab.operators import index as ix
from reclab.operators.ordering import global_index
from tests.conftest import SF_SMALL


def _mapping(df):
    return {r["label"]: r["idx"] for r in df.collect()}


def test_ties_by_label(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "x string")
    assert _mapping(ix.fit_index(df, "x")) == {"c": 0, "a": 1, "b": 2}


def test_null_skipped_in_fit_and_raises_in_apply(spark):
    df = spark.createDataFrame([("b",), (None,)], "x string")
    m = ix.fit_index(df, "x")
    assert _mapping(m) == {"b": 0}
    with pytest.raises(Exception, match="unseen label"):
        ix.apply_index(df, m, "x", "x_ix").collect()


def test_unseen_policies(spark):
    fit = spark.createDataFrame([("a",), ("b",)], "x string")
    other = spark.createDataFrame([("a",), ("z",)], "x string")
    m = ix.fit_index(fit, "x")
    with pytest.raises(Exception, match="unseen label in column x: z"):
        ix.apply_index(other, m, "x", "i").collect()
    assert ix.apply_index(other, m, "x", "i", "skip").count() == 1
    kept = {r["x"]: r["i"] for r in ix.apply_index(other, m, "x", "i", "keep").collect()}
    assert kept == {"a": 0, "z": 2}


def test_equals_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    from reclab.plans import data

    df = data.split_table(spark, SF_SMALL)
    ours = _mapping(ix.fit_index(df, "track_id"))
    model = StringIndexer(inputCol="track_id", outputCol="o").fit(df)
    theirs = {lab: i for i, lab in enumerate(model.labels)}
    assert ours == theirs


def test_global_index_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").alias("b"))
    ours = global_index(df, [F.desc("a"), F.asc("b")], num_partitions=7)
    ref = df.withColumn("idx", F.row_number().over(Window.orderBy(F.desc("a"), F.asc("b"))) - 1)
    assert ours.select("a", "b", "idx").exceptAll(ref.select("a", "b", "idx")).count() == 0
    assert ours.count() == 5000
    small = global_index(df, [F.desc("a"), F.asc("b")])  # single-task path
    assert small.select("a", "b", "idx").exceptAll(ref.select("a", "b", "idx")).count() == 0


def test_result_independent_of_partitioning(spark):
    from reclab.plans import data

    df = data.split_table(spark, SF_SMALL)
    a = _mapping(ix.fit_index(df.repartition(1), "user_id"))
    b = _mapping(ix.fit_index(df.repartition(13), "user_id"))
    assert a == b and sorted(a.values()) == list(range(len(a)))


def test_written_footer_has_no_label_metadata(spark, tmp_out):
    from pyspark.ml.feature import StringIndexer

    from reclab.sources import io

    df = spark.createDataFrame([(f"L{i}",) for i in range(300)], "x string")
    out = StringIndexer(inputCol="x", outputCol="i").fit(df).transform(df)
    assert out.schema["i"].metadata  # the indexer attaches its labels
    io.write_table(out.select("i"), f"{tmp_out}/t")
    back = spark.read.parquet(f"{tmp_out}/t")
    assert back.schema["i"].metadata == {}
