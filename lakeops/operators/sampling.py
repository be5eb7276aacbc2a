"""Splits and samples that do not depend on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakeops.functions.scalar import key_bucket, sample_order

# Multipliers for the four line item keys.
PRICE_KEY_FACTORS = (31, 17, 7, 1)


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    factors: Sequence[int],
    shares: Sequence[int],
) -> list[DataFrame]:
    """Disjoint, exhaustive parts in the ratio of ``shares``.

    Each part is a filter over the same scan; nothing is shuffled or sorted,
    unlike ``randomSplit``, whose result also changes with the partitioning.
    """
    bucket = key_bucket(keys, factors, sum(shares))
    parts, low = [], 0
    for share in shares:
        parts.append(df.where((bucket >= low) & (bucket < low + share)))
        low += share
    return parts


def train_test_split(
    df: DataFrame, keys: Sequence[str], factors: Sequence[int] = PRICE_KEY_FACTORS
) -> tuple[DataFrame, DataFrame]:
    """Three quarters to train on, one quarter to test on."""
    test, train = hash_split(df, keys, factors, (1, 3))
    return train, test


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows chosen by a hash of their key; each task keeps only its best ``n``."""
    return df.orderBy(sample_order(keys, seed), *keys).limit(n)
