"""Session helpers: a configured local session for tests and benches, and the
checkpoint directory rule (use the cluster's, set one only when unset and local)."""

from __future__ import annotations

import atexit
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Settings used where nothing else sets them.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "reclab", extra: dict | None = None) -> SparkSession:
    """The active session as it is, or a new one with ``DEFAULTS``.

    Whatever spark-submit, a properties file or the active session already
    sets stays as it is: the defaults, ``shuffle_partitions`` and ``master``
    only fill gaps.  ``extra`` is the caller's explicit choice and wins."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        from pyspark import SparkConf, SparkContext

        # start the JVM (if spark-submit has not) so that SparkConf sees what was submitted
        SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).setAll(list((extra or {}).items())))
        given = SparkConf()
        wanted = dict(DEFAULTS)
        if shuffle_partitions is not None:
            wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        if master is not None:
            wanted["spark.master"] = master
        # the launcher itself turns the progress bar on, so that one says nothing
        wanted = {k: v for k, v in wanted.items()
                  if k == "spark.ui.showConsoleProgress" or not given.contains(k)}
        spark = SparkSession.builder.appName(app_name).config(map={**wanted, **(extra or {})}).getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it.
    Only a local-mode session without one gets a private temporary folder
    (tests); a cluster session without one is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):  # local-cluster is a cluster
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3) for checkpoints")
    path = tempfile.mkdtemp(prefix="reclab-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint directory for intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/reclab-{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(clear_scratch)
    _SCRATCH.append((spark, path))
    for made in getattr(_OWN, "made", ()):
        made.append((spark, path))
    return path


def materialise(df, name: str):
    """``df`` written once under the checkpoint folder and read back.  The
    shuffle files of the write go when it has ended."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df, name: str):
    """``df`` itself where reading it takes no shuffle, else its copy under the
    checkpoint folder: for tables that are scanned several times."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return materialise(df, name) if "Exchange" in plan else df


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
_RELEASING: dict = {}


@contextmanager
def shuffles_released(spark: SparkSession):
    """The shuffle files of a query that is run inside go when it has ended, not
    when the driver happens to collect its plan.  Threads share the setting: the
    last one that leaves restores what was set before."""
    key = id(spark._jsparkSession)
    with _LOCK:
        n, before = _RELEASING.get(key, (0, None))
        if not n:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _RELEASING[key] = n + 1, before
    try:
        yield
    finally:
        with _LOCK:
            n, before = _RELEASING.pop(key)
            if n > 1:
                _RELEASING[key] = n - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


#: Seconds between two collections of the driver's garbage.
COLLECT_EVERY = 5.0


@contextmanager
def collected(spark: SparkSession):
    """While a long call runs in the driver's JVM, its garbage is collected every
    few seconds: shuffle files and cached blocks that nothing refers to any more
    go only then (as with ``spark.cleaner.periodicGC.interval``, which waits half
    an hour)."""
    ended, runs = threading.Event(), []
    gc = spark.sparkContext._jvm.System.gc

    def run():
        while not ended.wait(COLLECT_EVERY):
            gc()
            runs.append(1)

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
        if runs:  # what the call itself has left
            gc()


_OWN = threading.local()


@contextmanager
def scratch_released():
    """Intermediate tables that this thread makes inside are deleted at the end,
    not only at that of the process."""
    stack = _OWN.__dict__.setdefault("made", [])
    stack.append(made := [])
    try:
        yield
    finally:
        stack.pop()
        for entry in made:
            if entry in _SCRATCH:
                _SCRATCH.remove(entry)
                _delete(*entry)


_SCRATCH: list[tuple[SparkSession, str]] = []


def clear_scratch() -> None:
    """Delete the intermediate tables of this process (also done at its end).
    DataFrames that still read them become unusable."""
    while _SCRATCH:
        try:
            _delete(*_SCRATCH.pop())
        except Exception:  # the session is gone already: its folder stays for the cluster's cleaner
            return


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
