"""Shared storage for written intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _configured_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary folder; a cluster session has no
    folder that all executors share, so it must name one.
    """
    folder = _configured_dir(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="market_lens_")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_written: list[tuple[SparkSession, str]] = []


@atexit.register
def remove_written() -> None:
    """Delete the intermediate tables of sessions that still run; called when Python ends."""
    while _written:
        spark, path = _written.pop()
        if spark.sparkContext._jsc is not None:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def temporary_path(spark: SparkSession, name: str) -> str:
    """A fresh path that is deleted when Python ends."""
    path = fresh_path(spark, name)
    _written.append((spark, path))
    return path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go with the end of its write. Otherwise they lie there until the driver's
    garbage collection comes upon them, and those of many writes add up."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there.

    For a table that several jobs or an iterative fit read: a lost executor costs a
    re-read of files, not a rerun of the plan behind them, and Spark knows the size of
    what it reads, so it broadcasts a small table and shuffles a large one. The files stay
    until Python ends, since frames made of the table may be read until then.
    """
    spark = df.sparkSession
    path = temporary_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def for_a_while(df: DataFrame, name: str, compression: str | None = None) -> Iterator[DataFrame]:
    """``materialize`` for a table that nothing made inside reads any more behind it: it is deleted there."""
    written = materialize(df, name, compression)
    path = _written[-1][1]
    try:
        yield written
    finally:
        _remove(df.sparkSession, path)
