"""Measured sizes, for deciding whether a side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLIT_BYTES = 128 * 1024 * 1024
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32


def measure(df: DataFrame) -> tuple[int, int]:
    """Exact row count and uncompressed bytes, in one aggregation."""
    width = F.lit(ROW_OVERHEAD).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            width = width + 8
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows, size


def fits_broadcast(df: DataFrame) -> bool:
    rows, size = measure(df)
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of input too small to have a split per core.

    For iterative fits, where one shuffle is repaid by every later pass. Larger
    input is left as its splits are. The estimate only steers speed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if estimate < cores * SPLIT_BYTES else df
