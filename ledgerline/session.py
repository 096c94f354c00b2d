"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_made: list[str] = []


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. A cluster brings its own session."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        # many different queries in one process: room for all their compiled code
        "spark.driver.extraJavaOptions": "-XX:ReservedCodeCacheSize=512m",
        "spark.sql.adaptive.enabled": "true",
        # small test data: keep all cores busy rather than merging small partitions
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("ledgerline")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def working_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, one below the warehouse, which is shared too."""
    found = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not found:
        found = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "scratch")
        spark.conf.set(CHECKPOINT_KEY, found)
    return found


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new path below ``folder`` or the shared one; :func:`clear_scratch` removes it."""
    path = os.path.join(folder or working_dir(spark), f"{name}-{uuid.uuid4().hex}")
    if not _made:
        atexit.register(_clear_at_exit, spark)
    _made.append(path)
    return path


def scratch_copies() -> set[str]:
    """The scratch copies there are now; for :func:`settled`."""
    return set(_made)


def settled(df: DataFrame, name: str, earlier: set[str]) -> DataFrame:
    """``df`` written and read back, and every scratch copy made since ``earlier`` removed: the result stands alone."""
    out = materialise(df, name)
    release(df.sparkSession, earlier | {_made[-1]})
    return out


def release(spark: SparkSession, earlier: set[str]) -> None:
    """Remove every scratch copy made since ``earlier``, which no frame reads any more."""
    for path in [p for p in _made if p not in earlier]:
        discard(spark, path)
        _made.remove(path)


@contextlib.contextmanager
def settings(spark: SparkSession, **held: str):
    """The session's settings while the block runs; dots of their names are written ``__``."""
    names = {k.replace("__", "."): v for k, v in held.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """While the block runs, a job's shuffle files go as it ends, not when the driver happens to collect its garbage."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def _clear_at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # Spark may be gone by then
        clear_scratch(spark)


def materialise(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write once, read back. Runs a job.

    Used where several passes need the same rows: the input is computed a single time,
    all passes see identical rows, and a lost executor costs a re-read, not a recompute.
    The copy stays as long as frames may read it, at most until the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name, folder)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and its path object: works on any store that Spark reaches."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    jsc = spark.sparkContext._jsc
    conf = jsc.hadoopConfiguration() if jsc else jvm.org.apache.hadoop.conf.Configuration()
    return where.getFileSystem(conf), where


def discard(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch copy of this application. Call it when no frame reads them any more."""
    while _made:
        discard(spark, _made.pop())
