"""Shapley attribution of predictions against a clustered background."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from math import factorial

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Two to the power of so many coalitions a row is the most the exact method takes on.
EXACT_FEATURES = 20
MAX_POINTS = 1000


def background(
    df: DataFrame,
    features: Sequence[str],
    k: int = 10,
    seed: int = 42,
    partitions: int = 64,
    on_values: bool = False,
) -> DataFrame:
    """At most ``k`` cluster means with the number of rows each stands for.

    With ``on_values`` each coordinate moves to the nearest value that occurs in the data,
    the smaller of two as near, so that a model is never asked about a count of 2.5.
    Otherwise means are taken over the final assignment, so their weighted mean is exactly the
    mean of the data. The starting points are drawn per partition; rows are dealt by
    value over a stated number of partitions and sorted, so that the clusters do not
    depend on the cluster's size or the input's files.
    """
    points = df.select(*features).repartition(partitions, *features).sortWithinPartitions(*features)
    assembled = VectorAssembler(inputCols=list(features), outputCol="_point").transform(points)
    clusters = KMeans(k=k, seed=seed, featuresCol="_point", predictionCol="cluster").fit(assembled)
    means = (
        clusters.transform(assembled)
        .groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("weight"), *[F.avg(f).alias(f) for f in features])
    )
    return nearest_values(means, df, features) if on_values else means


def nearest_values(points: DataFrame, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Points whose coordinates are each replaced by the nearest value of that column.

    The points, at most ``MAX_POINTS``, cut each column's axis into intervals. One partial
    aggregation keeps the least and the greatest value of every interval: the values beside
    a point are among them, whatever the number of rows. Columns come back as doubles.
    """
    held = points.limit(MAX_POINTS + 1).collect()
    if len(held) > MAX_POINTS:
        raise ValueError(f"more than {MAX_POINTS} background points; cluster them first")
    if not held:
        return points
    cuts = {f: sorted({float(r[f]) for r in held}) for f in features}
    table = F.create_map(*[part for f in features for part in (F.lit(f), F.lit(cuts[f]))])
    cells = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    cells = cells.unpivot([], list(features), "feature", "value").where("value IS NOT NULL AND NOT isnan(value)")
    below = F.size(F.filter(table[F.col("feature")], lambda cut: cut <= F.col("value")))
    ends = cells.groupBy("feature", below.alias("below")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    values = ends.groupBy("feature").agg(F.flatten(F.collect_list(F.array("low", "high"))).alias("values"))
    known = {r["feature"]: sorted(r["values"]) for r in values.collect()}
    rows = []
    for row in held:
        moved = {f: min(known[f], key=lambda v, at=row[f]: (abs(v - at), v)) for f in features}
        rows.append(tuple(moved.get(c, row[c]) for c in points.columns))
    kinds = ", ".join(f"`{c}` {'double' if c in features else kind}" for c, kind in points.dtypes)
    return df.sparkSession.createDataFrame(rows, kinds)


def _reference_points(points: DataFrame, features: Sequence[str]) -> Column:
    """The background as an array of structs; at most ``MAX_POINTS`` of them."""
    rows = points.select("weight", *features).limit(MAX_POINTS + 1).collect()
    if len(rows) > MAX_POINTS:
        raise ValueError(f"more than {MAX_POINTS} background points; cluster them first")
    total = sum(r["weight"] for r in rows)
    return F.array(
        *[
            F.struct(
                F.lit(r["weight"] / total).alias("share"),
                *[F.lit(float(r[f])).alias(f) for f in features],
            )
            for r in rows
        ]
    )


def _permutation_sets(count: int, samples: int, seed: int) -> list[tuple[int, list[tuple[int, float]]]]:
    """Coalitions met along sampled orderings, with each feature's signed weight.

    Every ordering is used with its reverse, which cancels much of the noise.
    """
    chooser = random.Random(seed)
    orders = []
    for _ in range(samples):
        order = list(range(count))
        chooser.shuffle(order)
        orders += [order, order[::-1]]
    signed: dict[int, dict[int, float]] = {}
    for order in orders:
        members = 0
        for feature in order:
            signed.setdefault(members, {}).setdefault(feature, 0.0)
            signed[members][feature] -= 1 / len(orders)
            members |= 1 << feature
            signed.setdefault(members, {}).setdefault(feature, 0.0)
            signed[members][feature] += 1 / len(orders)
    return [(members, sorted(parts.items())) for members, parts in sorted(signed.items())]


def shapley_values(
    rows: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    points: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    method: str = "exact",
    samples: int = 200,
    seed: int = 42,
) -> DataFrame:
    """One row per input row and feature with its share of the prediction.

    ``predict`` adds a ``prediction`` column to a frame with the feature columns. A
    row becomes one row per coalition and background point, features outside the
    coalition taken from the point; all are scored together, averaged per coalition
    and combined. ``method`` is ``exact``, over every coalition, or ``sampled``, over those
    of ``samples`` random orderings and their reverses; too many features for the exact
    method are refused. The shares of a row sum to its prediction minus the background's.
    A row is scored for every coalition and point: ``rows`` are the few to be explained.
    """
    count = len(features)
    if method not in ("exact", "sampled"):
        raise ValueError(method)
    if method == "exact" and count > EXACT_FEATURES:
        raise ValueError(f"{count} features: exact attribution takes {EXACT_FEATURES}; use method='sampled'")
    names = F.array(*[F.lit(f) for f in features])
    subset = F.col("_subset")
    if method == "exact":
        full = 1 << count
        coalitions = F.sequence(F.lit(0).cast("long"), F.lit(full - 1).cast("long"))
        sized = [factorial(s) * factorial(count - s - 1) / factorial(count) for s in range(count)]
        weights = F.array(*[F.lit(w) for w in sized])
        size = F.bit_count(subset)

        def contribution(i: int) -> Column:
            inside = F.shiftright(subset, i).bitwiseAND(F.lit(1).cast("long")) == 1
            return F.when(inside, F.get(weights, size - 1)).otherwise(-F.get(weights, size))

        signed = F.array(*[contribution(i) for i in range(count)])
    else:
        table = _permutation_sets(count, samples, seed)
        coalitions = F.array(*[F.lit(s).cast("long") for s, _ in table])
        signed = None

    place = [*key, "_subset"]
    scored = (
        rows.select(*key, *features, F.explode(coalitions).alias("_subset"))
        # Few rows carry much work each; spread the coalitions before scoring.
        .repartition(*place)
        .withColumn("_point", F.explode(_reference_points(points, features)))
        .select(
            *place,
            F.col("_point.share").alias("_share"),
            *[
                F.when(F.shiftright(subset, i).bitwiseAND(F.lit(1).cast("long")) == 1, F.col(f))
                .otherwise(F.col(f"_point.{f}"))
                .alias(f)
                for i, f in enumerate(features)
            ],
        )
    )
    value = predict(scored).groupBy(*place).agg(F.sum(F.col("_share") * F.col("prediction")).alias("_value"))
    if signed is not None:
        parts = value.select(*key, "_value", F.posexplode(signed).alias("_i", "_weight"))
    else:
        entries = [(s, i, w) for s, signs in table for i, w in signs]
        lookup = rows.sparkSession.createDataFrame(entries, "_subset long, _i int, _weight double")
        # As many entries as sampled orderings have steps: fixed by ``samples``.
        parts = value.join(F.broadcast(lookup), "_subset").select(*key, "_value", "_i", "_weight")
    return (
        parts.groupBy(*key, "_i")
        .agg(F.sum(F.col("_weight") * F.col("_value")).alias("phi"))
        .select(*key, F.get(names, F.col("_i")).alias("feature"), "phi")
    )


def mean_importance(values: DataFrame) -> DataFrame:
    """Signed and absolute mean share per feature, in ascending signed order."""
    return (
        values.groupBy("feature")
        .agg(F.avg("phi").alias("mean_shap"), F.avg(F.abs("phi")).alias("mean_abs_shap"))
        .orderBy("mean_shap")
    )
