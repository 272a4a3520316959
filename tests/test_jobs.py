"""The prepare -> train -> evaluate jobs over files, including resume."""

from pyspark.sql import functions as F

from reclab.plans import data, jobs
from reclab.sources import io
from tests.conftest import SF_SMALL


def test_three_jobs_end_to_end(spark, tmp_out):
    train, val, test = data.splits(spark, SF_SMALL)
    paths = {}
    for name, df in (("train", train), ("val", val.select("user_id", "count", "track_id")),
                     ("test", test)):
        paths[name] = f"{tmp_out}/raw_{name}"
        io.write_table(df, paths[name])
    out = jobs.prepare(spark, paths["train"], paths["val"], paths["test"], f"{tmp_out}/fmt")
    fmt_val = jobs.read_formatted(spark, f"{tmp_out}/fmt", "val")
    assert fmt_val.count() == val.count()
    assert spark.read.parquet(out["train"]).schema["user"].metadata == {}
    saved = jobs.train(spark, f"{tmp_out}/fmt", f"{tmp_out}/models", [3], [0.1], [1.0, 2.0],
                       max_iter=2)
    assert len(saved) == 2 and all(io.model_exists(spark, p) for p in saved)
    again = jobs.train(spark, f"{tmp_out}/fmt", f"{tmp_out}/models", [3], [0.1], [1.0, 2.0],
                       max_iter=2)
    assert again == saved  # nothing refitted: same keys, models exist
    res = jobs.evaluate(spark, f"{tmp_out}/fmt", f"{tmp_out}/models", f"{tmp_out}/results",
                        [3], [0.1], [1.0, 2.0], k=50, max_iter=2)
    assert res.count() == 2
    none_left = jobs.evaluate(spark, f"{tmp_out}/fmt", f"{tmp_out}/models", f"{tmp_out}/results",
                              [3], [0.1], [1.0, 2.0], k=50, max_iter=2)
    assert none_left.count() == 0
    test = jobs.evaluate(spark, f"{tmp_out}/fmt", f"{tmp_out}/models", f"{tmp_out}/results",
                         [3], [0.1], [1.0, 2.0], k=50, max_iter=2, split="test")
    assert test.count() == 2  # the same results table takes another split
    logged = io.read_results(spark, f"{tmp_out}/results").where("split = 'val'")
    assert logged.count() == 2 and logged.where(F.col("map").between(0, 1)).count() == 2


def test_cli_prepare_train_evaluate(spark, tmp_out, capsys):
    train, val, test = data.splits(spark, SF_SMALL)
    raw = {}
    for name, df in (("train", train), ("val", val), ("test", test)):
        raw[name] = f"{tmp_out}/r_{name}"
        io.write_table(df, raw[name])
    fmt, models, res = f"{tmp_out}/f", f"{tmp_out}/m", f"{tmp_out}/res"
    jobs.main(["prepare", raw["train"], raw["val"], raw["test"], fmt, "--fraction", "0.5"])
    jobs.main(["train", fmt, models, "--ranks", "3", "--regs", "0.1", "--alphas", "1"])
    jobs.main(["evaluate", fmt, models, res, "--ranks", "3", "--regs", "0.1", "--alphas", "1",
               "--k", "20"])
    assert io.read_results(spark, res).count() == 1
    assert "map" in capsys.readouterr().out
