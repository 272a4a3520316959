"""The three batch jobs of the original workflow, over paths (all paths are
parameters; nothing is read from or written to the working directory).

* ``prepare``: read the three splits with a declared schema, keep all
  held-out users plus a fraction of the others in train, fit dense ids on
  all splits, write formatted splits and the two mappings (no metadata).
* ``train``: fit every grid point not already saved (models keyed by
  variant, parameters and a data fingerprint).
* ``evaluate``: score every saved grid point not yet in the results table on
  a held-out split and append typed rows.

    python -m reclab.plans.jobs prepare TRAIN VAL TEST OUT
    python -m reclab.plans.jobs train OUT MODELS --ranks 10 --regs 0.1 --alphas 1
    python -m reclab.plans.jobs evaluate OUT MODELS RESULTS --ranks 10 --regs 0.1 --alphas 1
"""

from __future__ import annotations

import argparse
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from reclab.operators import index as ix
from reclab.operators import split as sp
from reclab.operators import sweep as sw
from reclab.sources import io
from reclab.sources.schema import FORMATTED, RESULTS, check_schema

SPLITS = ("train", "val", "test")


def prepare(spark: SparkSession, train_path: str, val_path: str, test_path: str, out_dir: str,
            fraction: float = 0.2, fit_on: str = "all", salt: str = "") -> dict:
    train, val, test = (io.read_interactions(spark, p) for p in (train_path, val_path, test_path))
    train = sp.subsample(train, val, test, fraction=fraction, salt=salt)
    users, items, frames = ix.index_splits(train, val, test, fit_on=fit_on)
    out = out_dir.rstrip("/")
    io.write_table(users, f"{out}/users", mode="overwrite")
    io.write_table(items, f"{out}/items", mode="overwrite")
    for name, df in zip(SPLITS, frames):
        io.write_table(df, f"{out}/{name}", mode="overwrite")
    return {n: f"{out}/{n}" for n in SPLITS + ("users", "items")}


def read_formatted(spark: SparkSession, data_dir: str, name: str):
    return check_schema(spark.read.schema(FORMATTED).parquet(f"{data_dir.rstrip('/')}/{name}"),
                        FORMATTED)


def _point(row, variant):
    return {"variant": variant, "rank": row["rank"], "reg_param": row["reg_param"], "alpha": row["alpha"]}


def train(spark: SparkSession, data_dir: str, models_dir: str, ranks, regs, alphas,
          variant: str = "raw", max_iter: int = 10, seed: int = 0, min_count: float = 2.0,
          cap: float = 10.0, parallelism: int = 1) -> list[str]:
    """Fit and save the models of the grid that are not saved yet."""
    setting = sw.Setting(max_iter=max_iter, seed=seed, min_count=min_count, cap=cap)
    df = read_formatted(spark, data_dir, "train").cache()
    try:
        key = sw.fingerprint(df)

        def one(row):
            path = sw.model_path(models_dir, variant, row["rank"], row["reg_param"], row["alpha"], key, setting)
            if not io.model_exists(spark, path):
                sw.fit_point(df, _point(row, variant), setting, path)
            return path

        points = sw.grid(spark, ranks, regs, alphas, (variant,)).collect()  # parameter table
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            return list(pool.map(one, points))
    finally:
        df.unpersist()


def evaluate(spark: SparkSession, data_dir: str, models_dir: str, results_path: str, ranks, regs,
             alphas, variant: str = "raw", split: str = "val", k: int = 500,
             labels_how: str = "full", max_iter: int = 10, seed: int = 0, min_count: float = 2.0,
             cap: float = 10.0, parallelism: int = 1):
    """Score saved models not yet in ``results_path`` under this setting;
    append each row as soon as it is known and return the new ones."""
    setting = sw.Setting(k, split, labels_how, max_iter, seed, float(min_count), float(cap))
    held = read_formatted(spark, data_dir, split).cache()
    try:
        key = sw.fingerprint(read_formatted(spark, data_dir, "train"))
        todo = sw.pending(sw.grid(spark, ranks, regs, alphas, (variant,)),
                          io.read_results(spark, results_path), setting, key)

        def one(row):
            started = time.time()
            path = sw.model_path(models_dir, variant, row["rank"], row["reg_param"], row["alpha"], key, setting)
            if not io.model_exists(spark, path):
                return None
            out = sw.result_row(io.load_model(path), held, _point(row, variant), setting, key, started)
            io.append_results(spark.createDataFrame([out], RESULTS), results_path,
                              io.result_key(dict(zip(RESULTS.names, out, strict=True))))
            return out

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            rows = [r for r in pool.map(one, todo.collect()) if r]  # parameter table
    finally:
        held.unpersist()
    return spark.createDataFrame(rows, RESULTS)


def _floats(s):
    return [float(x) for x in s.split(",")]


def main(argv=None):
    from reclab.session import build_session

    ap = argparse.ArgumentParser(prog="reclab.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare")
    p.add_argument("train")
    p.add_argument("val")
    p.add_argument("test")
    p.add_argument("out")
    p.add_argument("--fraction", type=float, default=0.2)
    p.add_argument("--fit-on", default="all")
    for name in ("train", "evaluate"):
        q = sub.add_parser(name)
        q.add_argument("data")
        q.add_argument("models")
        if name == "evaluate":
            q.add_argument("results")
            q.add_argument("--split", default="val")
            q.add_argument("--k", type=int, default=500)
            q.add_argument("--labels", default="full")
        q.add_argument("--ranks", default="10")
        q.add_argument("--regs", default="0.1")
        q.add_argument("--alphas", default="1")
        q.add_argument("--variant", default="raw")
        q.add_argument("--max-iter", type=int, default=10)
        q.add_argument("--seed", type=int, default=0)
        q.add_argument("--min-count", type=float, default=2.0)
        q.add_argument("--cap", type=float, default=10.0)
        q.add_argument("--parallelism", type=int, default=1)
    a = ap.parse_args(argv)
    spark = build_session()
    if a.cmd == "prepare":
        print(prepare(spark, a.train, a.val, a.test, a.out, a.fraction, a.fit_on))
        return
    ranks = [int(x) for x in a.ranks.split(",")]
    fit = {"variant": a.variant, "max_iter": a.max_iter, "seed": a.seed, "min_count": a.min_count,
           "cap": a.cap, "parallelism": a.parallelism}
    points = (ranks, _floats(a.regs), _floats(a.alphas))
    if a.cmd == "train":
        print(train(spark, a.data, a.models, *points, **fit))
    else:
        evaluate(spark, a.data, a.models, a.results, *points, split=a.split, k=a.k,
                 labels_how=a.labels, **fit).show(truncate=False)


if __name__ == "__main__":
    main()
