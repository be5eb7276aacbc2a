"""Row-level changes as functions from a DataFrame to a DataFrame.

Versioned tables apply the same semantics on disk, writing only what changed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.sizing import fits_broadcast
from lakeops.operators.skew import join_one_per_key
from lakeops.sources.files import literal_rows


class SchemaMismatch(ValueError):
    """A batch does not fit the table it is written to."""


def holds(predicate: Column) -> Column:
    """Three-valued logic to two: an unknown predicate does not select the row."""
    return F.coalesce(predicate, F.lit(False))


def insert_rows(target: DataFrame, rows: Iterable[tuple]) -> DataFrame:
    """Add literal rows; duplicates are kept."""
    return target.unionByName(literal_rows(target.sparkSession, rows, target.schema))


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    return target.where(~holds(predicate))


def assigned(schema: T.StructType, assignments: dict[str, Column | object]) -> dict[str, Column]:
    """Assignments as columns of the target's types."""
    unknown = set(assignments) - set(schema.names)
    if unknown:
        raise SchemaMismatch(f"no such column: {sorted(unknown)}")
    return {
        name: (value if isinstance(value, Column) else F.lit(value)).cast(schema[name].dataType)
        for name, value in assignments.items()
    }


def update_where(
    target: DataFrame, predicate: Column, assignments: dict[str, Column | object]
) -> DataFrame:
    """Set columns where the predicate holds. One narrow projection, no shuffle."""
    values = assigned(target.schema, assignments)
    hit = holds(predicate)
    return target.select(
        [
            F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )


def aligned(source: DataFrame, schema: T.StructType) -> DataFrame:
    """The source's columns in the target's order and types."""
    missing = set(schema.names) - set(source.columns)
    if missing:
        raise SchemaMismatch(f"source lacks {sorted(missing)}")
    return source.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def one_per_key(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Source rows by key: ``_hits`` rows and one of them as ``_new``.

    The partial aggregation folds a key that fills the source before the shuffle,
    and the result cannot multiply target rows when joined.
    """
    return source.groupBy(*on).agg(
        F.count(F.lit(1)).alias("_hits"), F.first(F.struct(*source.columns)).alias("_new")
    )


def matched_flag() -> Column:
    """True on a single source match; a second match for one target row is an error.

    The row number makes the error depend on the joined row. Without it the
    optimizer may test the source before the join, where an unmatched repeated key
    is no error.
    """
    repeated = (F.col("_hits") > 1) & (F.monotonically_increasing_id() >= 0)
    message = F.lit("merge: several source rows match one target row")
    return (
        F.when(repeated, F.raise_error(message).cast("boolean"))
        .when(F.col("_hits") == 1, F.lit(True))
        .otherwise(F.lit(False))
    )


def unmatched_source(target: DataFrame, source: DataFrame, on: Sequence[str], small: bool) -> DataFrame:
    """Source rows whose key the target does not hold.

    Small source: target keys are filtered against it map-side, so the target is
    never shuffled. Otherwise target keys are made distinct first, which folds a
    hot key before the shuffle.
    """
    keys = target.select(*on)
    if small:
        keys = keys.join(F.broadcast(source.select(*on).distinct()), list(on), "left_semi")
    return join_one_per_key(source, keys.distinct(), on, "left_anti", small).select(source.columns)


def merge_upsert(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Matched rows take every source column, null included; the rest are inserted.

    A null key matches nothing. With a source measured small the target is not
    shuffled; otherwise only its rows outside hot keys are.
    """
    source = aligned(source, target.schema)
    small = fits_broadcast(source)
    joined = join_one_per_key(target, one_per_key(source, on), on, "left", small)
    kept = joined.withColumn("_match", matched_flag()).select(
        [F.when(F.col("_match"), F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in target.columns]
    )
    return kept.unionByName(unmatched_source(target, source, on, small))


def upsert_three_way(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """The same upsert as three sets: new rows, replaced rows, untouched rows."""
    source = aligned(source, target.schema)
    small = fits_broadcast(source)
    per_key = one_per_key(source, on)
    new = unmatched_source(target, source, on, small)
    replaced = (
        join_one_per_key(target, per_key, on, "inner", small)
        .where(matched_flag())
        .select([F.col("_new")[c].alias(c) for c in target.columns])
    )
    untouched = join_one_per_key(target, per_key, on, "left_anti", small).select(target.columns)
    return untouched.unionByName(replaced).unionByName(new)


# Widenings an append may apply without being asked.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint"},
    "smallint": {"int", "bigint"},
    "int": {"bigint"},
    "float": {"double"},
}


def evolved_schema(schema: T.StructType, batch: T.StructType, merge_schema: bool) -> T.StructType:
    """The table's schema after an append, or an error when the batch does not fit."""
    known = {f.name.lower(): f for f in schema.fields}
    added = []
    for field in batch.fields:
        have = known.get(field.name.lower())
        if have is None:
            added.append(T.StructField(field.name, field.dataType, True))
            continue
        source, wanted = field.dataType.simpleString(), have.dataType.simpleString()
        if source != wanted and wanted not in _WIDER.get(source, set()):
            raise SchemaMismatch(f"column {field.name}: {source} does not fit {wanted}")
    if added and not merge_schema:
        names = [f.name for f in added]
        raise SchemaMismatch(f"columns {names} are not in the table; pass merge_schema=True to add them")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + added)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the schema's order and types; a column the rows lack is null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        [
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def append_rows(target: DataFrame, batch: DataFrame, merge_schema: bool = False) -> DataFrame:
    """Append a batch, refusing unknown columns unless evolution is asked for."""
    schema = evolved_schema(target.schema, batch.schema, merge_schema)
    return conform(target, schema).unionByName(conform(batch, schema))
