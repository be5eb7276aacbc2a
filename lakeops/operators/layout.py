"""Compaction and clustering of Parquet folders."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources.files import file_inventory

TARGET_BYTES = 128 * 1024 * 1024
# What a task sorts takes so much memory at most, however small its rows are in a file.
SORT_BYTES = 512 * 1024 * 1024
# A long holds the curve; ranks have bits for the files and some for the rows inside one.
CURVE_BITS = 62
LEAST_BITS = 6
EXTRA_BITS = 4
MOST_BITS = 12
SAMPLED_ROWS = 64
TEXT_CHARS = 32


def target_tasks(size_bytes: int, target_bytes: int = TARGET_BYTES) -> int:
    return max(1, -(-size_bytes // target_bytes))


def sort_tasks(rows: int, schema: T.StructType) -> int:
    """Tasks that sort so many rows within ``SORT_BYTES`` each: identities and pointers, 8 bytes
    a number and 40 any other value."""
    width = 64 + sum(8 if isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)) else 40 for f in schema)
    return max(1, -(-rows * width // SORT_BYTES))


def folder_bytes(spark: SparkSession, path: str) -> int:
    total = file_inventory(spark, path).agg(F.coalesce(F.sum("size_bytes"), F.lit(0)))
    return total.first()[0]


def curve_bits(columns: int, tasks: int) -> int:
    """Bits of each column's rank on a curve that is cut into ``tasks`` files.

    The files need log2(tasks) bits together; some more order the rows inside a file.
    """
    needed = -(-max(tasks - 1, 0).bit_length() // columns)
    if columns * max(needed, 1) > CURVE_BITS:
        raise ValueError(f"{columns} columns over {tasks} files need more than {CURVE_BITS} bits; cluster by fewer")
    return max(1, min(max(LEAST_BITS, needed + EXTRA_BITS), MOST_BITS, CURVE_BITS // columns))


def _orderable(column: str, kind: T.DataType) -> Column:
    """The value, or a number or short text that keeps its order."""
    value = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return F.substring(value, 1, TEXT_CHARS)
    raise TypeError(f"cannot cluster by {column}: {kind.simpleString()} has no order")


def _cut_points(values: list, bits: int) -> list:
    """2^bits - 1 quantiles of the values; a frequent one is several of them, so that a rank
    is the share of rows below and few distinct values still use all bits."""
    known = sorted(v for v in values if v is not None and v == v)
    return [known[len(known) * i >> bits] for i in range(1, 1 << bits)] if known else []


def ranked(df: DataFrame, columns: Sequence[str], bits: int) -> tuple[DataFrame, list[str]]:
    """Columns as ranks below 2^bits: the number of cut points not above the value.

    Cut points are quantiles of a sample of ``SAMPLED_ROWS`` rows a cut point, all of it
    the driver sees. The sample only steers the layout. Nulls rank lowest, with the least
    values.
    """
    names = [f"_rank_{i}" for i in range(len(columns))]
    values = [_orderable(c, df.schema[c].dataType) for c in columns]
    keys = df.select(*[v.alias(n) for v, n in zip(values, names, strict=True)])
    share = min(1.0, SAMPLED_ROWS * 2**bits / max(df.count(), 1))
    sample = (keys if share == 1.0 else keys.sample(share, seed=17)).collect()
    steps = F.array(*[F.lit(1 << b) for b in range(bits - 1, -1, -1)])
    out = df
    for name, value in zip(names, values, strict=True):
        cuts = _cut_points([row[name] for row in sample], bits)
        kind = "string" if cuts and isinstance(cuts[0], str) else "double"
        # One literal, however many cut points.
        table = F.from_json(F.lit(json.dumps([c if kind == "string" else repr(c) for c in cuts])), "array<string>")
        table = table.cast(f"array<{kind}>")

        out = out.withColumn(name, F.aggregate(steps, F.lit(0), _halving(table, value)))
    return out, names


def _halving(table: Column, value: Column) -> Callable[[Column, Column], Column]:
    """Moves on by a width as long as the cut point there is not above the value."""
    return lambda at, width: F.when(F.get(table, at + width - 1) <= value, at + width).otherwise(at)


def interleaved(ranks: Sequence[str], bits: int) -> Column:
    """Bits of several ranks taken in turn: near rows get near numbers on all of them."""
    if bits * len(ranks) > CURVE_BITS:
        raise ValueError(f"{len(ranks)} ranks of {bits} bits do not fit a long")
    value = F.lit(0).cast("long")
    for bit in range(bits):
        for place, name in enumerate(ranks):
            one = F.shiftright(F.col(name).cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            value = value + F.shiftleft(one, bit * len(ranks) + place)
    return value


def clustered(
    df: DataFrame,
    partition_by: Sequence[str],
    cluster_by: Sequence[str],
    tasks: int,
    identity: Sequence[str],
) -> DataFrame:
    """Rows range-partitioned into ``tasks`` even parts by partition, cluster value, row.

    The row identity at the end lets the ranges cut through a partition or cluster
    value that holds a large share of all rows; no part depends on one value. Several
    cluster columns are laid along one curve inside each partition.
    """
    columns = df.columns
    if len(cluster_by) > 1:
        bits = curve_bits(len(cluster_by), tasks)
        df, ranks = ranked(df, cluster_by, bits)
        df = df.withColumn("_z", interleaved(ranks, bits))
        cluster = ["_z"]
    else:
        cluster = list(cluster_by)
    if tasks == 1:
        placed = df.coalesce(1) if not cluster else df.repartition(1)
    elif partition_by or cluster:
        placed = df.repartitionByRange(tasks, *partition_by, *cluster, *identity)
    else:
        # Joining whole input splits needs no shuffle.
        placed = df.coalesce(tasks)
    if partition_by or cluster:
        placed = placed.sortWithinPartitions(*partition_by, *cluster)
    return placed.select(columns)


def rewrite_folder(
    spark: SparkSession,
    source: str,
    out: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
) -> DataFrame:
    """Write the same rows to a new folder in files near ``target_bytes``, or smaller ones
    where their rows are too many for one task to sort.

    With ``cluster_by`` rows are also ordered, so Parquet row groups hold narrow
    ranges and filters on those columns skip them. The old folder is left as it is.
    """
    rows = spark.read.schema(schema).parquet(source)
    identity = ["_file", "_row"]
    # Eight bytes a row tell files apart; where two agree, rows of both share a range.
    file = F.xxhash64(F.col("_metadata.file_path"))
    keyed = rows.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    tasks = target_tasks(folder_bytes(spark, source), target_bytes)
    if partition_by or cluster_by:
        # Counted from the files' footers.
        tasks = max(tasks, sort_tasks(rows.count(), schema))
    placed = clustered(keyed, partition_by, cluster_by, tasks, identity).drop(*identity)
    writer = placed.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(out)
    return spark.read.schema(schema).parquet(out)
