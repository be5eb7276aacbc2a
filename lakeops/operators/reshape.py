"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def melt_features(
    df: DataFrame, label: str, features: Sequence[str], name: str = "feature", value: str = "norm_value"
) -> DataFrame:
    """One row per label and feature. Expands inside the scan's stage, no shuffle."""
    return df.select(label, *features).unpivot(label, list(features), name, value)
