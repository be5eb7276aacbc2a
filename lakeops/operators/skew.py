"""Joins whose left side may hold a large share of its rows under one key.

Adaptive execution splits a skewed partition only where both join inputs come
straight from a shuffle. The right side here is an aggregate, one row per key, so
hot keys are handled by plan: their rows join map-side, the rest is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators import sizing
from lakeops.sources.files import literal_rows

# A key is hot above both: fewer rows are no burden to a task, and above the second it
# has HOT_TIMES the rows of an even task, which partitions / HOT_TIMES keys can have.
HOT_ROWS = 1_000_000
HOT_TIMES = 1
# Wide rows met by hot keys are copied so many times, and the hot rows dealt over the copies.
SALTS = 64
SAMPLE_ROWS = 20_000_000


def hot_keys(df: DataFrame, on: Sequence[str]) -> DataFrame | None:
    """Keys too frequent for one task, null included; at most partitions / HOT_TIMES.

    Frequencies of large tables are read off a sample of the keys, where a hot key
    is met thousands of times. The answer only picks the way a row is joined.
    """
    keys = df.select(*on)
    total = keys.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    seen = keys if share == 1.0 else keys.sample(share, seed=17)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(HOT_ROWS, HOT_TIMES * total / partitions) * share
    counts = seen.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > least)
    rows = [tuple(r) for r in counts.select(*on).collect()]
    return literal_rows(df.sparkSession, rows, keys.schema) if rows else None


def join_one_per_key(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, small: bool
) -> DataFrame:
    """Join rows to at most one row per key: ``left``, ``inner`` or ``left_anti``.

    A right side measured ``small`` is broadcast. Otherwise hot keys of the left side
    are split off: the right rows they can meet are as few as the keys. They are
    measured; if they are too wide to broadcast, each is copied ``SALTS`` times and the
    hot rows are dealt over the copies, so that a hot key is spread over as many tasks.
    """
    if small:
        return left.join(F.broadcast(right), list(on), how)
    hot = hot_keys(left, on)
    if hot is None:
        return left.join(right, list(on), how)
    met = right.join(F.broadcast(hot), list(on), "left_semi")
    wide = sizing.measure(met)[1] > sizing.BROADCAST_BYTES
    flags = hot.select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(on)], F.lit(True).alias("_hot"))
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(flags[f"_hot_{i}"]) for i, k in enumerate(on)])
    flagged = left.join(F.broadcast(flags), same, "left").select(*[left[c] for c in left.columns], "_hot")
    hot_rows = flagged.where(F.col("_hot").isNotNull()).drop("_hot")
    other_rows = flagged.where(F.col("_hot").isNull()).drop("_hot")
    rest = other_rows.join(right, list(on), how)
    if not wide:
        return hot_rows.join(F.broadcast(met), list(on), how).unionByName(rest)
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))
    dealt = hot_rows.withColumn("_salt", salt)
    copies = met.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt").unionByName(rest)
