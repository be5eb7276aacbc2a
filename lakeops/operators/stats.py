"""Aggregates over numeric columns: errors, scaling, correlation, histograms, trends.

Everything here is one or two partial aggregations. Values one pass needs from
another (a maximum, a range) come from a scalar subquery, so the plan stays lazy
and holds no join. Only the robust steps of a trend run and join as they are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops import scratch
from lakeops.functions.scalar import zero_clean
from lakeops.operators.sizing import fits_broadcast
from lakeops.operators.skew import join_one_per_key

# Bins of distances from a trend for each power of two, and the bin of none.
RESIDUAL_BINS = 64
NO_RESIDUAL = -1_000_000


def rmse_by(df: DataFrame, by: str, truth: str, prediction: str) -> DataFrame:
    error = F.pow(F.col(truth) - F.col(prediction), 2)
    return df.groupBy(by).agg(F.sqrt(F.avg(error)).alias("rmse"))


def metric_columns(truth: str, prediction: str) -> dict[str, Column]:
    """mse, mae, rmse and r2 as aggregate expressions of a single pass."""
    error = F.col(truth) - F.col(prediction)
    squares = F.sum(error * error)
    total = F.var_pop(truth) * F.count(F.lit(1))
    return {
        "mse": F.avg(error * error),
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": F.when(total > 0, 1 - squares / total).when(squares == 0, F.lit(1.0)).otherwise(F.lit(0.0)),
    }


def regression_metrics(df: DataFrame, truth: str, prediction: str, prefix: str = "test") -> DataFrame:
    return df.agg(*[c.alias(f"{prefix}_{n}") for n, c in metric_columns(truth, prediction).items()])


def max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every named column divided by its own maximum.

    All maxima are one scalar subquery, bound once; columns read its fields.
    """
    tops = df.agg(F.struct(*[F.max(c).alias(c) for c in columns]).alias("tops")).scalar()
    bound = df.select(F.struct(*df.columns).alias("row"), tops.alias("tops"))
    row, top = F.col("row"), F.col("tops")
    return bound.select(
        *[(F.try_divide(row[c], top[c]) if c in columns else row[c]).alias(c) for c in df.columns]
    )


def corr_matrix(df: DataFrame, columns: Sequence[str], places: int | None = None) -> DataFrame:
    """Pearson correlations as rows ``(a, b, corr)``, both orders and the diagonal."""

    def shape(value: Column) -> Column:
        return zero_clean(value, places) if places is not None else value

    pairs = [(a, a) for a in columns] + list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        value = shape(F.col(f"`{i}`"))
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), value.alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), value.alias("corr")))
    return wide.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bins per column; the last bin is closed, empty bins count zero.

    One pass for the ranges, one to count: each row yields a small map-side count
    per column, so only ``bins`` rows per column and task are shuffled.
    """
    ranges = df.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
        ).alias("r")
    ).scalar()
    # Bound once a row; the cells read its fields.
    bound = df.select(F.struct(*columns).alias("row"), ranges.alias("ranges"))
    cells = []
    for c in columns:
        value, lo, hi = F.col("row")[c], F.col("ranges")[f"lo_{c}"], F.col("ranges")[f"hi_{c}"]
        # A single-valued column gets a unit range centred on its value.
        lo, hi = F.when(hi > lo, lo).otherwise(lo - 0.5), F.when(hi > lo, hi).otherwise(hi + 0.5)
        index = F.least(F.floor((value - lo) / ((hi - lo) / bins)), F.lit(bins - 1).cast("long"))
        cells.append(F.struct(F.lit(c).alias("column"), index.alias("bin"), lo.alias("lo"), hi.alias("hi")))
    counted = (
        bound.select(F.inline(F.array(*cells)))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "lo", "hi")
        .agg(*[F.count(F.when(F.col("bin") == i, 1)).alias(f"n{i}") for i in range(bins)])
    )
    every = F.array(
        *[F.struct(F.lit(i).cast("long").alias("bin"), F.col(f"n{i}").alias("n")) for i in range(bins)]
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select("column", "lo", width.alias("width"), F.inline(every)).select(
        "column",
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_hi"),
        "n",
    )


def local_trend(
    df: DataFrame,
    x: str,
    y: str,
    by: str,
    bins: int = 200,
    points: int = 21,
    bandwidth: float = 0.2,
    robust_steps: int = 0,
) -> DataFrame:
    """Smoothed trend of ``y`` against ``x`` in [0, 1], per value of ``by``.

    Rows collapse to ``bins`` sets of sums per group before anything is shuffled.
    Each bin is then sent only to the grid points its bandwidth reaches, where a
    tricube-weighted least squares line is evaluated.

    Every robust step weighs the rows anew, by the bisquare of their distance from the
    trend so far over six times the group's median distance, so that outliers lose their
    pull; the classic smoother takes three. The median is read off a histogram with
    ``RESIDUAL_BINS`` bins an octave. A point whose rows all lost their weight keeps its
    trend of the step before. Steps run as they are called: each writes one row per group
    to the scratch folder.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(by), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    )
    trend = _binned_trend(rows, by, F.lit(1.0), bins, points, bandwidth)
    for _ in range(robust_steps):
        # A line is an array with a place for every point, so that a row finds its two at once.
        known = F.map_from_entries(F.collect_list(F.struct("_point", "trend")))
        every = F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))
        line = F.transform(every, lambda at: F.try_element_at("_known", at))
        lines = _written(trend.groupBy(by).agg(known.alias("_known")).select(by, line.alias("_line")))
        scales = _residual_scales(_beside(rows, lines, by, points), by)
        known = _written(lines.join(scales, lines[by].eqNullSafe(scales[by])).select(lines[by], "_line", "_scale"))
        beside = _beside(rows, known, by, points).withColumn("_far", F.try_divide(F.abs("_residual"), "_scale"))
        inner = 1 - F.col("_far") * F.col("_far")
        weight = F.when(F.col("_residual").isNull(), 0.0).when(F.col("_scale") == 0, 1.0)
        weighed = beside.withColumn("_weight", weight.when(F.col("_far") < 1, inner * inner).otherwise(0.0))
        new = _binned_trend(weighed, by, F.col("_weight"), bins, points, bandwidth)
        old = lines.select(by, F.posexplode("_line").alias("_point", "trend")).where(F.col("trend").isNotNull())
        old = old.withColumn("_point", F.col("_point").cast("long"))
        both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        trend = both.groupBy(by, "_point").agg(F.max_by("trend", "_new").alias("trend"))
    return trend.select(by, (F.col("_point") * (1.0 / (points - 1))).alias("x"), "trend")


def _binned_trend(rows: DataFrame, by: str, weight: Column, bins: int, points: int, reach: float) -> DataFrame:
    """by, _point and trend of rows (by, _x, _y) that count with a weight; those of none not
    even if x or y is no number. A filter would have the weight worked out twice."""
    step = 1.0 / (points - 1)
    bin_no = F.least(F.floor(F.col("_x") * bins), F.lit(bins - 1).cast("long"))

    def total(of: Column) -> Column:
        return F.sum(F.when(weight > 0, of).otherwise(0.0))

    sums = rows.groupBy(F.col(by), bin_no.alias("bin")).agg(
        total(weight).alias("n"),
        total(weight * F.col("_x")).alias("sx"),
        total(weight * F.col("_y")).alias("sy"),
        total(weight * F.col("_x") * F.col("_x")).alias("sxx"),
        total(weight * F.col("_x") * F.col("_y")).alias("sxy"),
    )
    centre = (F.col("bin") + 0.5) / bins
    first = F.greatest(F.ceil((centre - reach) / step), F.lit(0).cast("long"))
    last = F.least(F.floor((centre + reach) / step), F.lit(points - 1).cast("long"))
    placed = sums.where(first <= last).withColumn("_point", F.explode(F.sequence(first, last)))
    distance = F.abs(F.col("_point") * step - centre) / reach
    near = F.when(distance < 1, F.pow(1 - F.pow(distance, 3), 3)).otherwise(0.0)
    weighted = placed.groupBy(by, "_point").agg(
        *[F.sum(near * F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")]
    )
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), spread)
    flat = F.col("sy") / F.col("n")
    fitted = flat + slope * (F.col("_point") * step - F.col("sx") / F.col("n"))
    return weighted.where(F.col("n") > 0).select(
        by, "_point", F.when(spread > 1e-9, fitted).otherwise(flat).alias("trend")
    )


def _beside(rows: DataFrame, lines: DataFrame, by: str, points: int) -> DataFrame:
    """Rows with their distance from their group's line, straight between grid points; null
    where the line has neither.

    Groups are one row each; beyond a measured size they are joined by shuffle, hot groups
    apart. Null is a group like any other. Columns build on each other and no filter looks at
    them, so each is worked out once a row.
    """
    key = [F.col(by).isNull().alias("_none"), F.coalesce(F.col(by).cast("string"), F.lit("")).alias("_group")]
    # What one step after another joins is as many rows as groups.
    one = lines.select(*key, *[c for c in lines.columns if c != by])
    met = join_one_per_key(rows.select("*", *key), one, ["_none", "_group"], "inner", fits_broadcast(one))
    place = F.col("_x") * (points - 1)
    low = F.least(F.greatest(F.floor(place), F.lit(0).cast("long")), F.lit(points - 2).cast("long"))
    out = met.withColumn("_low", low)
    out = out.withColumns({"_one": F.get("_line", F.col("_low")), "_two": F.get("_line", F.col("_low") + 1)})
    left, right = F.coalesce("_one", "_two"), F.coalesce("_two", "_one")
    out = out.withColumn("_residual", F.col("_y") - (left + (right - left) * (place - F.col("_low"))))
    return out.drop("_none", "_group", "_line", "_low", "_one", "_two")


def _residual_scales(rows: DataFrame, by: str) -> DataFrame:
    """Six median distances per group, at least a billionth of its mean size of y."""
    size = F.abs(F.col("_residual"))
    bin_no = F.when(size > 0, F.floor(F.log2(size) * RESIDUAL_BINS)).otherwise(F.lit(NO_RESIDUAL).cast("long"))
    counted = rows.groupBy(by, bin_no.alias("_bin")).agg(
        F.count("_residual").alias("_n"), F.sum(F.when(F.col("_residual").isNotNull(), F.abs("_y"))).alias("_size")
    ).where(F.col("_n") > 0)
    # At most RESIDUAL_BINS for each power of two a double has.
    inside = Window.partitionBy(by)
    upto = inside.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.select(
        by, "_bin", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(inside).alias("_all"),
        (F.sum("_size").over(inside) / F.sum("_n").over(inside)).alias("_mean"),
    )
    middle = summed.where(F.col("_upto") * 2 >= F.col("_all")).groupBy(by).agg(F.min("_bin").alias("_bin"), F.max("_mean").alias("_mean"))
    edge = F.when(F.col("_bin") == NO_RESIDUAL, 0.0).otherwise(F.pow(F.lit(2.0), (F.col("_bin") + 1) / RESIDUAL_BINS))
    return middle.select(by, F.greatest(6 * edge, F.col("_mean") * 1e-9).alias("_scale"))


def _written(df: DataFrame) -> DataFrame:
    """The rows, written to the scratch folder and read again."""
    path = scratch.fresh(df.sparkSession, "trend")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
