"""Scans, literal rows, file inventories and file streams."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The 29 positional columns of the flight CSV, in file order.
FLIGHT_COLUMNS = (
    "Year Month DayofMonth DayOfWeek DepartureTime CRSDepartureTime ArrivalTime "
    "CRSArrivalTime UniqueCarrier FlightNumber TailNumber ActualElapsedTime "
    "CRSElapsedTime AirTime ArrivalDelay DepartureDelay Origin Destination Distance "
    "TaxiIn TaxiOut Cancelled CancellationCode Diverted CarrierDelay WeatherDelay "
    "NASDelay SecurityDelay LateAircraftDelay"
).split()


def scan_csv_positional(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Read a headerless CSV by position.

    Every field is read as text, as the file has it; columns named in ``types``
    are then converted with ``try_cast`` so a stray header line or an ``NA``
    becomes null instead of failing the job.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
    raw = spark.read.schema(schema).csv(path)
    types = types or {}

    def column(position: int, name: str) -> Column:
        source = F.col(f"_c{position}")
        if name in types:
            source = source.try_cast(types[name])
        return source.alias(name)

    return raw.select([column(i, name) for i, name in enumerate(names)])


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows written in the program, with stated types so nulls need no inference.

    Handed over as an Arrow table, they become a local relation of known size.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = [dict(zip(schema.names, row)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def file_inventory(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame:
    """One row per data file: ``path``, ``size_bytes`` and any partition columns.

    Uses the binary file source without its content column, so files are listed
    by tasks and never opened.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    if base:
        reader = reader.option("basePath", base)
    files = reader.load(list(paths))
    extra = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.select("path", F.col("length").alias("size_bytes"), *extra)


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    max_files: int | None = None,
) -> DataFrame:
    """An unbounded table over a folder that keeps receiving Parquet files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
