"""Amended feeds: micro-batches written idempotently, first or last write wins.

The stream's checkpoint replays a batch after a failure; because the write depends on keys only, a replay changes nothing.
A table that is replaced lives in numbered versions under its path: a version is whole once its writer's success mark is
there, readers take the latest whole one, and the one before it stays, so a crash at any moment loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyforge.operators.dedup import filter_new_rows, upsert_do_update


def _store(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _present(spark: SparkSession, path: str) -> bool:
    """Whether files are there; an error other than a missing path is raised, not taken for an empty table."""
    fs, at = _store(spark, path)
    return bool(fs.exists(at)) and any(not x.getPath().getName().startswith(("_", ".")) for x in fs.listStatus(at))


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, at = _store(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
    whole = [n for n in names if n.startswith("v") and n[1:].isdigit() and fs.exists(_store(spark, f"{path}/{n}/_SUCCESS")[1])]
    return sorted(int(n[1:]) for n in whole)


def latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest whole version of a table that last_write_wins keeps."""
    found = _versions(spark, path)
    return spark.read.parquet(f"{path}/v{found[-1]}") if found else None


def first_write_wins(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """Appends rows with new keys to a parquet table."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(path) if _present(spark, path) else spark.createDataFrame([], batch.schema)
        filter_new_rows(batch, old, keys, order).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_write_wins(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """Replaces rows by key: each batch writes the next version, then those before the last one go."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        found = _versions(spark, path)
        old = spark.read.parquet(f"{path}/v{found[-1]}") if found else spark.createDataFrame([], batch.schema)
        upsert_do_update(old, batch, keys, order).write.mode("overwrite").parquet(f"{path}/v{found[-1] + 1 if found else 0}")
        for n in found[:-1]:
            fs, at = _store(spark, f"{path}/v{n}")
            fs.delete(at, True)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_stages(stages: list[tuple[int, str, Callable[[], dict]]], should_stop: Callable[[], bool] = lambda: False) -> Iterator[tuple[str, dict]]:
    """Runs stages by priority and name; a stop takes effect between stages."""
    for _, name, f in sorted(stages, key=lambda s: s[:2]):
        if should_stop():
            return
        yield name, f()
