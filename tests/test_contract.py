"""Driver contract: entry runs, registered queries equal their SQL oracle
(on sf0.001 here; the driver checks sf0.01)."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

FAST = ["split_holdout", "sample_users_exact", "index_items", "labels_top_tied",
        "ordered_label_list", "metric_precision", "metric_map", "metric_ndcg", "error_by_group",
        "count_transform_stats", "subsample_splits", "cold_item_split"]


def test_every_query_has_oracle_or_is_declared_rows_only():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    rows_only = {n for n in set(q) - set(sql) if not re.match(r"op\d+_|pipeline$", n)}  # the corpus ones test themselves
    assert rows_only <= {"als_evaluate", "search_report", "cold_start_report", "factor_layout",
                         "final_test_eval"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["n_users_scored"] > 0
    assert "map" in df.columns and "ndcg_at_k" in df.columns


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "embeddings", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    def rows(pdf):
        return sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
                      for r in pdf[cols].itertuples(index=False))
    assert rows(got) == rows(want)
