"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Files of different values that a task keeps open; rows of further values are sorted.
OPEN_FILES = 32


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Writes by value inside keep a file open for each value a task holds, ``OPEN_FILES`` at
    most, instead of sorting all its rows by value in memory."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write, then hand back a reader over what was written."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> DataFrame:
    """Write one folder per value of ``by``.

    A plain ``partitionBy`` makes every task write a file for every value it
    holds. The rebalance hint gathers each value first; adaptive execution then
    cuts a value that is too large for one task and joins small ones.
    """
    with open_files(df.sparkSession):
        df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_small_files(df: DataFrame, path: str, by: Sequence[str], tasks: int) -> DataFrame:
    """The layout maintenance starts from: many tasks, each writing every value."""
    with open_files(df.sparkSession):
        df.repartition(tasks).write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
