"""Mixing of sources to target weights by Poisson replication.

A source's rate is its target share of the output over its number of documents. Every
document draws its number of copies from a Poisson distribution with that mean, by
inverting the distribution function at a uniform number hashed from the seed and the id.
Copies are exploded and shuffled by a hash of seed, id and copy. The same seed gives the
same mix on any cluster; expected sizes follow the targets, and no row is looked at twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import staged

UNIT_BITS = 52


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest."""
    return _digits(seed, *keys).cast("double") / F.lit(float(1 << UNIT_BITS))


def _digits(seed: int, *keys: Column) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, UNIT_BITS // 4), 16, 10).cast("long")


def distribution(rate: Column) -> Column:
    """P(X <= k) for k = 0 .. K, with K so far out that the rest is below 2**-52."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("points"))

    def step(state: Column, k: Column) -> Column:
        log = state["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = state["total"] + F.exp(log)
        return F.struct(
            log.alias("log"), total.alias("total"), F.concat(state["points"], F.array(total)).alias("points")
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["points"])


def rates(
    df: DataFrame, source_col: str, weights: dict[str | None, float] | None, power: float, total: float | None
) -> DataFrame:
    """source, rate: one row per source that has documents and weight."""
    counts = df.groupBy(F.col(source_col).alias("_source")).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    if weights is None:
        weighted = counts.withColumn("_w", F.pow("_n", F.lit(power)))
    else:
        given = df.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "_name string, _w double")
        weighted = counts.join(F.broadcast(given), F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    counted = staged(weighted.where("_w > 0"), "mix-counts")
    sums = counted.agg(F.sum("_n"), F.sum("_w")).first()
    size = float(total if total is not None else sums[0] or 0)
    return counted.select(
        "_source", (F.lit(size) * F.col("_w") / F.lit(sums[1] or 1.0) / F.col("_n")).alias("rate")
    )


def mix(
    df: DataFrame,
    weights: dict[str | None, float] | None = None,
    power: float = 0.5,
    total: float | None = None,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """The input's columns, then ``copy`` (from 0) and ``shuffle_key``, in order of the key.

    ``weights`` gives each source its share (null is a source too; a source without weight
    gets no copies); without it shares follow ``count ** power``. ``total`` is the expected
    size, by default that of the input. Rows with equal ids draw alike. An input column named ``copy`` or
    ``shuffle_key`` is replaced.
    """
    table = rates(df, source_col, weights, power, total).select(
        F.col("_source"), distribution(F.col("rate")).alias("_points")
    )
    names = [c for c in df.columns if c not in ("copy", "shuffle_key")]
    # The input's row is one struct: its columns may have any names.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    key, source = F.col("row").getField(id_col), F.col("row").getField(source_col)
    # The joined side has one row per source; the plan broadcasts it only while it is small.
    drawn = rows.join(staged(table, "mix-rates"), source.eqNullSafe(F.col("_source")))
    point = uniform(seed, key)
    times = F.size(F.filter("_points", lambda p: p <= point))
    copies = drawn.select("row", times.alias("times")).where("times > 0")
    exploded = copies.select("row", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("copy"))
    keyed = exploded.select("row", "copy", _digits(seed + 1, key, F.col("copy")).alias("shuffle_key"))
    return keyed.orderBy("shuffle_key", key, "copy").select("row.*", "copy", "shuffle_key")
