"""The registered SQL: text for known queries only, and equal to the operators."""

import duckdb
import pytest

from reclab.llm import ngram_join, registry, repeats

from .helpers import awkward, clashing

SF = "/root/testdata/sf0.001"
CASES = {"op8_suffix_dedup": lambda d: repeats.remove_repeats(d, keep_text=False),
         "op10_ngram_join": lambda d: ngram_join.linked_components(d, 4, 85).drop("a", "c")}


def rows(pdf):
    return sorted(map(tuple, pdf[sorted(pdf.columns)].astype(object).values.tolist()))


def sql_rows(name, documents):
    con = duckdb.connect()
    con.register("documents", documents)
    return rows(con.execute(registry.ORACLES[name]).df())


def test_oracles_are_sql_of_registered_queries():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    assert all(isinstance(sql, str) for sql in registry.ORACLES.values())


@pytest.mark.parametrize("name", CASES)
def test_sql_equals_query(spark, name):
    documents = duckdb.connect().execute(f"SELECT * FROM '{SF}/documents.parquet'").df()
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == sql_rows(name, documents)


@pytest.mark.parametrize("name", CASES)
def test_sql_equals_operator_on_awkward_rows(spark, name):
    df = clashing(spark, awkward(), "node", "key").dropna(subset=["doc_id"]).dropDuplicates(["doc_id"])
    want = sql_rows(name, df.select("doc_id", "text").toArrow())
    assert rows(CASES[name](df).toPandas()) == want
