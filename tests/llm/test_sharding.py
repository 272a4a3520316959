from pyspark.sql import functions as F

from reclab.llm import sharding

from .helpers import SCHEMA, awkward, clashing, empty, frame


def check(rows, shards, size_of, tolerance=0.001):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    total, largest = sum(map(size_of, rows)), max(map(size_of, rows))
    for s in range(shards):
        assert abs(sum(map(size_of, by.get(s, []))) - total / shards) <= largest + 2 * tolerance * total / shards


def test_near_equal_bytes_and_gapless_slots(spark):
    rows = awkward()
    got = sharding.shard(frame(spark, rows), sharding.text_bytes() + 16, shards=7).collect()
    assert len(got) == len(rows)
    check(got, 7, lambda r: len((r["text"] or "").encode()) + 16)


def test_hot_text_is_cut_exactly(spark):
    rows = [(i, "the same text", "en", "a", 1) for i in range(3000)] + [
        (i, f"text {i}", "en", "a", 1) for i in range(3000, 6000)]
    got = sharding.shard(frame(spark, rows), F.lit(1), shards=40).groupBy("shard").count().collect()
    assert len(got) == 40 and all(abs(r["count"] - 150) <= 1 for r in got)


def test_ranges_inside_a_shard_keep_slots_gapless(spark):
    rows = [(i, f"text {i}", "en", "a", 1) for i in range(500)]
    got = sharding.shard(frame(spark, rows), F.lit(10), shards=3, range_bytes=200).collect()
    check(got, 3, lambda r: 10)


def test_repeated_rows_few_rows_empty_and_clashes(spark):
    got = sharding.shard(frame(spark, [(1, "x", None, None, 1)] * 5), F.lit(1), shards=2).collect()
    check(got, 2, lambda r: 1)
    assert len(sharding.shard(frame(spark, [(1, "x", None, None, 1)]), F.lit(1), shards=40).collect()) == 1
    assert sharding.shard(empty(spark), F.lit(1)).count() == 0
    clash = sharding.shard(clashing(spark, awkward(), "shard", "slot"), F.lit(1), shards=2)
    assert {"shard", "shard_", "slot", "slot_"} <= set(clash.columns)
    assert spark.createDataFrame([], SCHEMA).schema == empty(spark).schema


def test_files_hold_every_row(spark, tmp_path):
    rows = awkward()
    sharding.write_shards(frame(spark, rows), str(tmp_path / "out"), sharding.text_bytes() + 16, shards=4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_own_names_do_not_clash(spark):
    rows = awkward()
    docs = clashing(spark, rows, "shard_key", "shard_row", "shard_size", "shard_range", "own")
    got = sharding.shard(docs, sharding.text_bytes() + 16, shards=5)
    assert got.columns == [*docs.columns, "shard", "slot"]
    check(got.collect(), 5, lambda r: len((r["text"] or "").encode()) + 16)


def test_ranges_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(sharding, "MAX_RANGES", 8)
    rows = [(i, f"text {i}", "en", "a", 1) for i in range(500)]
    check(sharding.shard(frame(spark, rows), F.lit(10), shards=3, range_bytes=20).collect(), 3, lambda r: 10)


def test_query_states_sizes_and_checksums(spark, tmp_path):
    import zlib

    rows = awkward()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sharding.query(spark, str(tmp_path)).collect()
    assert sorted(repr((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == sorted(
        repr((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))) for d, t, *_ in rows)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    check(got, 40, lambda r: r["size"])
