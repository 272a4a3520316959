"""The results log: concurrent, repeated and killed appends."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from reclab.sources import io
from reclab.sources.schema import RESULTS
from tests.test_io_sweep import result


def row(i):
    return result("raw", i / 1000, k=i)


def put(spark, path, i, keyed=True):
    one = spark.createDataFrame([row(i)], RESULTS)
    return io.append_results(one, path, io.result_key(dict(zip(RESULTS.names, row(i)))) if keyed else None)


def test_two_hundred_appends_from_eight_threads(spark, tmp_out):
    path = f"{tmp_out}/log"
    with ThreadPoolExecutor(8) as pool:
        assert all(pool.map(lambda i: put(spark, path, i), range(200)))
    assert sorted(r.k for r in io.read_results(spark, path).collect()) == list(range(200))


def test_a_repeated_append_adds_nothing(spark, tmp_out):
    path = f"{tmp_out}/log"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put(spark, path, i % 4), range(40)))
    assert sum(won) == 4
    assert sorted(r.k for r in io.read_results(spark, path).collect()) == [0, 1, 2, 3]
    assert not put(spark, path, 2)
    put(spark, path, 2, keyed=False)  # without a key it is an append of its own
    assert io.read_results(spark, path).count() == 5


def test_a_killed_append_leaves_nothing(spark, tmp_out, monkeypatch):
    path = f"{tmp_out}/log"
    put(spark, path, 1)
    real = io._jvm_fs

    class Dies:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, *a):
            raise RuntimeError("killed")

        def delete(self, *a):
            raise RuntimeError("killed")

    monkeypatch.setattr(io, "_jvm_fs", lambda *a: (Dies(real(*a)[0]), real(*a)[1]))
    with pytest.raises(RuntimeError):
        put(spark, path, 2)
    monkeypatch.setattr(io, "_jvm_fs", real)
    assert [r.k for r in io.read_results(spark, path).collect()] == [1]
    assert io.clear_staging(spark, path) == 0 and io.clear_staging(spark, path, older_than=-60) == 1
    assert put(spark, path, 2) and io.read_results(spark, path).count() == 2


def test_reads_a_log_of_plain_files(spark, tmp_out):
    path = f"{tmp_out}/log"
    spark.createDataFrame([row(7)], RESULTS).write.parquet(path)
    put(spark, path, 8)
    assert sorted(r.k for r in io.read_results(spark, path).collect()) == [7, 8]


def test_thresholds_enter_each_row_once(spark):
    from reclab.plans.logs import _thresholds

    rows = [("train", "U1", 3), ("train", "U1", 1), ("train", "U2", 1), ("train", None, 9), ("val", "U3", 0),
            ("val", None, 2), ("test", "U1", None)]
    got = {(s, m): (n, mean) for s, m, n, mean in _thresholds(
        spark.createDataFrame(rows, "split string, user_id string, count long"))}
    want = {("train", 1.0): (2, 3.5), ("train", 2.0): (1, 6.0), ("train", 3.0): (1, 6.0),
            **{("train", float(m)): (0, 9.0) for m in range(4, 9)}, ("val", 1.0): (0, 2.0), ("val", 2.0): (0, 2.0)}
    assert got == want


def test_ids_are_fitted_once_a_session(spark):
    from reclab.plans import data

    assert data.formatted(spark, "/root/testdata/sf0.001")[0] is data.formatted(spark, "/root/testdata/sf0.001")[0]
