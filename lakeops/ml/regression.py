"""Regression on principal components: training, evaluation, early stopping."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark import SparkContext, StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, Bucketizer, PCAModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops import scratch
from lakeops.operators.sizing import spread
from lakeops.operators.stats import metric_columns

# The covariances of so many features, eight bytes each squared, reach the driver.
MAX_FEATURES = 1024
# Ranks of the quantiles that part a component into bins are exact to one in so many rows.
QUANTILE_ACCURACY = 20_000
# Cells a task works on in each pass of boosting.
TASK_CELLS = 50_000


def component_stages(features: Sequence[str] | str, components: int) -> list:
    """Assemble, centre and project. Spark's PCA does not centre what it transforms,
    hence the scaler. ``features`` may name one vector column instead of a list."""
    stages: list = []
    raw = features
    if not isinstance(features, str):
        raw = "_assembled"
        stages.append(VectorAssembler(inputCols=list(features), outputCol=raw))
    stages.append(StandardScaler(inputCol=raw, outputCol="_centred", withMean=True, withStd=False))
    stages.append(PCA(k=components, inputCol="_centred", outputCol="features"))
    return stages


def elastic_net(train: DataFrame, label: str, alpha: float, l1_ratio: float) -> LinearRegression:
    """Least squares with the penalty ``alpha*l1_ratio*|w| + alpha*(1-l1_ratio)/2*w^2``.

    Spark's normal solver divides the quadratic part by the label's population
    deviation, so it is scaled back. That solver needs one pass over the data.
    """
    deviation = train.agg(F.stddev_pop(label)).first()[0]
    first = alpha * l1_ratio
    second = alpha * (1 - l1_ratio) * deviation
    return LinearRegression(
        labelCol=label,
        regParam=first + second,
        elasticNetParam=first / (first + second) if first + second else 0.0,
        standardization=False,
        solver="normal",
        maxIter=2000,
        tol=1e-12,
    )


def boosted_trees(
    label: str,
    max_depth: int = 3,
    learning_rate: float = 0.1,
    n_estimators: int = 100,
    seed: int = 42,
) -> GBTRegressor:
    """Squared-error boosting. Rounds are cut loose from their lineage every tenth."""
    return GBTRegressor(
        labelCol=label,
        maxDepth=max_depth,
        stepSize=learning_rate,
        maxIter=n_estimators,
        lossType="squared",
        seed=seed,
        checkpointInterval=10,
    )


@dataclass
class Stopped:
    """A boosted model cut after its best round, and the held-out error of every round."""

    model: PipelineModel
    errors: list[float]
    best_round: int
    stopped_after: int


def best_round(errors: Sequence[float], patience: int) -> tuple[int, int]:
    """The round with the least error up to the one where training stops, and that one.

    Rounds count from 1. Training stops once ``patience`` rounds brought no less error than
    the least so far; of equal errors the earliest counts.
    """
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        if at - best >= patience:
            return best + 1, at + 1
    return best + 1, len(errors)


def fit_with_patience(
    df: DataFrame,
    held_out: str,
    features: Sequence[str] | str,
    regressor: GBTRegressor,
    components: int,
    patience: int = 10,
) -> Stopped:
    """Fit on the rows where the flag ``held_out`` is false; keep the best round on the others.

    The whole budget of rounds is trained, as Spark's boosting cannot go on from a model;
    one pass over the held-out rows then measures the ensemble after every round, and the
    rounds after the best are cut off, so scoring pays for that round only.
    """
    fitted = fit(df.where(~F.col(held_out)), features, regressor, components)
    *before, boosted = fitted.stages
    rows = PipelineModel(before).transform(df.where(held_out))
    errors = list(boosted.evaluateEachIteration(rows, "squared"))
    best, stopped = best_round(errors, patience)
    return Stopped(PipelineModel([*before, _first_rounds(boosted, best)]), errors, best, stopped)


def _first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The ensemble after so many rounds, with the model's columns."""
    java = model._java_obj
    gateway = SparkContext._active_spark_context._gateway
    kind = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(kind.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], float(model.treeWeights[i])
    cut = kind.GBTRegressionModel(model.uid, trees, weights)
    for name in ("labelCol", "featuresCol", "predictionCol", "maxDepth", "stepSize", "seed", "lossType"):
        cut.set(cut.getParam(name), java.getOrDefault(java.getParam(name)))
    cut.set(cut.getParam("maxIter"), rounds)
    found = GBTRegressionModel(cut)
    found._transfer_params_from_java()
    return found


def covariance(df: DataFrame, vector_col: str) -> np.ndarray:
    """Sample covariance of a vector column, d x d numbers for vectors of length d.

    Deviations and correlations are summed up by the JVM's tree aggregates.
    """
    found = df.select(Summarizer.metrics("count", "std").summary(F.col(vector_col)).alias("s")).first()["s"]
    if not found["count"]:
        raise ValueError("no rows to fit components on")
    deviations = found["std"].toArray()
    if len(deviations) > MAX_FEATURES:
        raise ValueError(f"{len(deviations)} features; components are fitted on {MAX_FEATURES} at most")
    together = Correlation.corr(df, vector_col).first()[0].toArray()
    # A constant feature has no correlation, and no covariance.
    return np.nan_to_num(together) * np.outer(deviations, deviations)


def principal_axes(spread_of: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes as columns and shares of variance, largest first. The largest entry of an axis
    is positive, so that the same data give the same axes."""
    values, axes = np.linalg.eigh((spread_of + spread_of.T) / 2)
    values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], axis=0) < 0, -1.0, 1.0)
    total = values.sum()
    shares = values / total if total else values
    return axes[:, :components], shares[:components]


def fit_components(df: DataFrame, features: Sequence[str] | str, components: int) -> PipelineModel:
    """Fit the component stages: Spark's, but for the decomposition of the d x d matrix.

    The vectors are centred first, which keeps the sums exact enough for features far from
    zero.
    """
    *before, pca = component_stages(features, components)
    centred = Pipeline(stages=before).fit(df)
    axes, shares = principal_axes(covariance(centred.transform(df), pca.getInputCol()), components)
    jvm = df.sparkSession._jvm
    java = jvm.org.apache.spark.ml.feature.PCAModel(
        pca.uid,
        jvm.org.apache.spark.ml.linalg.DenseMatrix(axes.shape[0], axes.shape[1], _doubles(df, axes.ravel(order="F")), False),
        jvm.org.apache.spark.ml.linalg.DenseVector(_doubles(df, shares)),
    )
    java.set(java.k(), components)
    java.setInputCol(pca.getInputCol()).setOutputCol(pca.getOutputCol())
    model = PCAModel(java)
    model._transfer_params_from_java()
    return PipelineModel([*centred.stages, model])


def _doubles(df: DataFrame, values: np.ndarray):
    spark = df.sparkSession
    array = spark.sparkContext._gateway.new_array(spark._jvm.double, len(values))
    for i, value in enumerate(values):
        array[i] = float(value)
    return array


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """The rows, held for the passes made over them unless they already are."""
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def used(df: DataFrame, features: Sequence[str] | str, regressor: Estimator) -> DataFrame:
    """Only the columns a fit reads, where the regressor is one whose columns are known."""
    if not isinstance(regressor, (GBTRegressor, LinearRegression)):
        return df
    params = [p for p in ("labelCol", "weightCol", "validationIndicatorCol") if regressor.hasParam(p)]
    named = {regressor.getOrDefault(p) for p in params if regressor.isDefined(p)}
    named |= {features} if isinstance(features, str) else set(features)
    return df.select([c for c in df.columns if c in named])


def takes_cells(regressor: Estimator) -> bool:
    """Whether rows of one cell may count as one row of their mean label and their number."""
    return (
        isinstance(regressor, GBTRegressor)
        and regressor.getLossType() == "squared"
        and regressor.getSubsamplingRate() == 1.0
        and regressor.getMinInstancesPerNode() == 1
        and not regressor.isSet("weightCol")
        and not regressor.isSet("validationIndicatorCol")
    )


def bin_values(df: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    """The values that stand for the bins of each column: all of them where they are at most
    ``bins``, else the middles of as many even shares of the rows."""
    shares = [(i + 0.5) / bins for i in range(bins)]
    measures = [F.percentile_approx(c, shares, QUANTILE_ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)]
    measures += [F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(columns)]
    measured = df.agg(*measures).first()
    out = []
    for i, column in enumerate(columns):
        values = measured[f"q{i}"] or []
        if measured[f"n{i}"] <= 2 * bins:
            every = [r[0] for r in df.select(column).distinct().limit(bins + 1).collect()]
            values = every if len(every) <= bins else values
        apart: list[float] = []
        for value in sorted(v for v in values if v is not None):
            # Neighbours whose middle is no number between them are one.
            if not apart or apart[-1] <= (apart[-1] + value) / 2 < value:
                apart.append(value)
        out.append(apart)
    return out


def cells(projected: DataFrame, regressor: GBTRegressor) -> DataFrame:
    """The rows as boosting sees them: one row for each combination of bins, with the mean
    label and the number of rows (``_rows``).

    Trees look at bins only, so every row of a cell gets the same predictions, and a squared
    loss needs of them no more than their number and mean: the ensemble is that of all rows.
    Bins meet half-way between the values that stand for them, which is where Spark puts its
    thresholds between the few values it then finds. There are at most ``maxBins`` to the
    power of the components, and never more cells than rows.
    """
    label, bins = regressor.getLabelCol(), regressor.getMaxBins()
    row = projected.select(F.col(label).cast("double").alias("_y"), vector_to_array(regressor.getFeaturesCol()).alias("_x"))
    size = projected.schema[regressor.getFeaturesCol()].metadata.get("ml_attr", {}).get("num_attrs")
    size = size or row.select(F.size("_x")).first()[0]
    columns = [f"_x{i}" for i in range(size)]
    wrong = F.col("_y").isNull() | F.isnan("_y")
    known = F.when(wrong, F.raise_error(F.lit("labels must not be null or NaN")).cast("double")).otherwise(F.col("_y"))
    wide = row.select(known.alias("_y"), *[F.get("_x", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    values = bin_values(wide, columns, bins)
    # Bucketizer's ranges are closed below, a tree's above: they start one number later.
    splits = [
        [-math.inf, *[math.nextafter((a + b) / 2, math.inf) for a, b in zip(v, v[1:])], math.inf] for v in values
    ]
    numbers = [f"_bin{i}" for i in range(size)]
    many = [i for i in range(size) if len(splits[i]) > 2]
    binned = wide
    if many:
        binned = Bucketizer(
            splitsArray=[splits[i] for i in many], inputCols=[columns[i] for i in many], outputCols=[numbers[i] for i in many]
        ).transform(wide)
    binned = binned.select("_y", *[(F.col(n) if i in many else F.lit(0)).cast("int").alias(n) for i, n in enumerate(numbers)])
    counted = binned.groupBy(*numbers).agg(F.avg("_y").alias(label), F.count(F.lit(1)).cast("double").alias("_rows"))
    stands = [F.get(F.lit(values[i] or [0.0]), F.col(n)) for i, n in enumerate(numbers)]
    return counted.select(label, "_rows", array_to_vector(F.array(*stands)).alias(regressor.getFeaturesCol()))


def fit_on_cells(df: DataFrame, regressor: GBTRegressor) -> GBTRegressionModel:
    """Boosting on cells, with as many passes as rounds over them and none over the rows."""
    spark = df.sparkSession
    with kept(df):
        count = df.count()
        if not count:
            raise ValueError("no rows to boost on")
        tasks = -(-count // TASK_CELLS)
        even = df.repartition(tasks) if tasks <= spark.sparkContext.defaultParallelism else df
        # Spark looks for thresholds among the square of maxBins rows: these are all of them.
        most = max(regressor.getMaxBins(), math.isqrt(count) + 1)
        with kept(even):
            model = regressor.copy({regressor.weightCol: "_rows", regressor.maxBins: most}).fit(even)
    # The model is one for rows: no weights, and the bins it was asked for.
    java = model._java_obj
    java.clear(java.getParam("weightCol"))
    java.set(java.getParam("maxBins"), regressor.getMaxBins())
    model.clear(model.weightCol)
    model._transfer_params_from_java()
    return model


def fit(df: DataFrame, features: Sequence[str] | str, regressor: Estimator, components: int) -> PipelineModel:
    """Components, then the regressor on them, as one model."""
    scratch.root(df.sparkSession)
    with kept(used(df, features, regressor)) as rows:
        projection = fit_components(rows, features, components)
        projected = projection.transform(rows)
        fitted = fit_on_cells(cells(projected, regressor), regressor) if takes_cells(regressor) else regressor.fit(projected)
    return PipelineModel([*projection.stages, fitted])


def train(df: DataFrame, features: Sequence[str] | str, regressor: Estimator, components: int) -> PipelineModel:
    """Fit on data that may come from few input splits."""
    return fit(spread(used(df, features, regressor)), features, regressor, components)


def evaluate(model: PipelineModel, train_df: DataFrame, test_df: DataFrame, label: str) -> dict[str, float]:
    """Errors on both parts, from one pass over their union."""
    both = train_df.withColumn("_part", F.lit("train")).unionByName(test_df.withColumn("_part", F.lit("test")))
    scored = model.transform(both).groupBy("_part")
    rows = scored.agg(*[c.alias(n) for n, c in metric_columns(label, "prediction").items()]).collect()
    return {f"{r['_part']}_{name}": r[name] for r in rows for name in ("mse", "mae", "rmse", "r2")}


def rmse_evaluator(label: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, metricName="rmse")
