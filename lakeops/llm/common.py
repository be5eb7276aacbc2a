"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeops import scratch

# Text handled at once inside a task; bounds the working memory of the vectorised code.
SLICE_BYTES = 1 << 18

# Rows of two longs that may be broadcast; larger sides are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch.fresh(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """Hint a broadcast only when a count shows at most ``BROADCAST_ROWS`` narrow rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def held_out(doc_id: Column | str) -> Column:
    """Rows no label may be learned from: crc32 of the id as text divides by five."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(frame: pd.DataFrame, text: str, limit: int = SLICE_BYTES) -> Iterator[pd.DataFrame]:
    """Consecutive parts of a batch with about ``limit`` characters of text each, one row at least."""
    sizes = frame[text].str.len().fillna(0).to_numpy()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield frame.iloc[start:i]
            start, held = i, 0
        held += size
    if start < len(frame):
        yield frame.iloc[start:]


def spans(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of consecutive parts of an Arrow text column, about ``limit`` bytes each."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, i - start
            start, held = i, 0
        held += size
    if start < len(column):
        yield start, len(column) - start


def relieved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what one of them needed goes back to the system before the next."""
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of the ``spans`` of a column."""
    for first, rows in spans(column, limit):
        yield first, column.slice(first, rows).to_pylist()


def map_slices(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, text: str = "text"
) -> DataFrame:
    """``function`` applied to frames of about ``SLICE_BYTES`` of text; never to a whole batch."""
    kinds = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in relieved(batches):
            for first, rows in spans(batch.column(text)):
                frame = function(batch.slice(first, rows).to_pandas())
                yield pa.RecordBatch.from_pandas(frame, schema=kinds, preserve_index=False)

    return df.mapInArrow(run, schema)


def rows_where(df: DataFrame, keep: Callable[[list[str | None]], np.ndarray], text_col: str) -> DataFrame:
    """The rows whose text ``keep`` finds true, all columns, filtered as they pass.

    Whole rows go through the Python worker as Arrow batches; the JVM holds none back.
    """
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in relieved(batches):
            for first, texts in text_slices(batch.column(place).cast(pa.string())):
                yield batch.slice(first, len(texts)).filter(pa.array(keep(texts).astype(bool)))

    return df.mapInArrow(run, df.schema)


def packed(df: DataFrame, value: Callable[[list[str | None]], np.ndarray], text_col: str) -> DataFrame:
    """``row`` (all columns as one struct, so that no name can clash) and a long from the text."""
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in relieved(batches):
            row = batch.column("row")
            for first, texts in text_slices(row.field(place).cast(pa.string())):
                numbers = pa.array(value(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([row.slice(first, len(texts)), numbers], ["row", "value"])

    return whole.mapInArrow(run, T.StructType([*whole.schema.fields, T.StructField("value", T.LongType())]))
