"""Column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_identifier(name: Column) -> Column:
    """A user name as an identifier: dots and at signs become underscores."""
    return F.translate(name, ".@", "__")


def key_bucket(keys: Sequence[str], factors: Sequence[int], buckets: int) -> Column:
    """Bucket of a row from integer keys.

    Plain integer arithmetic: the same row lands in the same bucket whatever the
    partitioning, engine or run.
    """
    if len(keys) != len(factors):
        raise ValueError("one factor per key")
    total = sum((F.col(k).cast("long") * f for k, f in zip(keys, factors)), F.lit(0).cast("long"))
    return F.pmod(total, F.lit(buckets).cast("long"))


def sample_order(keys: Sequence[str], seed: int) -> Column:
    """A repeatable pseudo-random order over rows, from their key columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def zero_clean(value: Column, places: int) -> Column:
    """Round, without leaving a negative zero."""
    return F.round(value, places) + F.lit(0.0)
