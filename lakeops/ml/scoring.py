"""Batch scoring, models as SQL functions, and drift runs."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import PCAModel, StandardScalerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.dml import update_where

Predict = Callable[[DataFrame], DataFrame]


def predictor(model: Transformer | Column) -> Predict:
    """A fitted model or a column expression as a function adding ``prediction``."""
    if isinstance(model, Column):
        return lambda df: df.withColumn("prediction", model)
    return model.transform


def score_batch(df: DataFrame, model: Transformer | Column, label: str, ts: datetime | None = None) -> DataFrame:
    """Label, prediction and one timestamp for the whole batch."""
    ts = ts or datetime.now(timezone.utc)
    scored = predictor(model)(df)
    return scored.select(label, "prediction", F.lit(ts).alias("ts"))


def drift_steps(df: DataFrame, columns: Sequence[str]) -> list[DataFrame]:
    """The data as it was, then with one more column zeroed at each step."""
    steps = [df]
    for column in columns:
        steps.append(update_where(steps[-1], F.col(column) >= 0.0, {column: 0.0}))
    return steps


# A tree model with more leaves than this is scored by its own transform: the parser and
# the code generator would work longer on the expression than most tables take.
MAX_LEAVES = 50_000


def _number(value: float) -> str:
    """A double literal that reads back as the same number."""
    if not math.isfinite(value):
        raise ValueError(f"no SQL literal for {value}")
    return f"{float(value)!r}D" if "e" in repr(float(value)) else f"{float(value)!r}E0"


def _sum(constant: float, factors: Sequence[float], names: Sequence[str]) -> str:
    """``constant + factor * name + ...`` without the terms that are nothing."""
    terms = [f"{_number(f)} * `{n}`" for f, n in zip(factors, names, strict=True) if f]
    return " + ".join([_number(constant), *terms])


def _case(node, names: Sequence[str]) -> str:
    """A fitted tree as nested CASE: a split goes left up to its threshold."""
    if node.subtreeDepth() == 0:
        return _number(node.prediction())
    split = node.split()
    test = f"`{names[split.featureIndex()]}` <= {_number(split.threshold())}"
    return f"CASE WHEN {test} THEN {_case(node.leftChild(), names)} ELSE {_case(node.rightChild(), names)} END"


def _leaves(model: GBTRegressionModel) -> int:
    return (model.totalNumNodes + len(model.treeWeights)) // 2


def _create(spark: SparkSession, name: str, inputs: Sequence[str], body: str) -> None:
    """A temporary SQL function of doubles; null when an input is."""
    declared = ", ".join(f"`{i}` DOUBLE" for i in inputs)
    missing = " OR ".join(f"`{i}` IS NULL" for i in inputs)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION `{name}`({declared}) RETURNS DOUBLE "
        f"RETURN CASE WHEN {missing} THEN NULL ELSE {body} END"
    )


def register_model(spark: SparkSession, name: str, model: PipelineModel) -> list[str]:
    """Make a trained model callable from SQL as ``name(feature, ...)``; returns the feature order.

    The model is compiled to one SQL expression, so scoring stays in generated code and
    Catalyst sees which columns it reads. Centring and axes fold into a linear model's
    coefficients. Trees become nested CASE over the components, which are the arguments of a
    second function, ``name_trees``, so that each is computed once a row.
    """
    assembler, scaler, pca, regressor = model.stages
    if not (
        isinstance(assembler, VectorAssembler)
        and isinstance(scaler, StandardScalerModel)
        and isinstance(pca, PCAModel)
    ):
        raise TypeError("expected a model trained by lakeops.ml.regression")
    inputs = assembler.getInputCols()
    mean, axes = scaler.mean.toArray(), pca.pc.toArray()
    if isinstance(regressor, LinearRegressionModel):
        factors = axes @ regressor.coefficients.toArray()
        _create(spark, name, inputs, _sum(regressor.intercept - mean @ factors, factors, inputs))
        return inputs
    if not isinstance(regressor, GBTRegressionModel):
        raise TypeError(f"no SQL form for {type(regressor).__name__}")
    if _leaves(regressor) > MAX_LEAVES:
        raise ValueError(f"{_leaves(regressor)} leaves; a SQL function has {MAX_LEAVES} at most: use model.transform")
    names = [f"component_{k}" for k in range(axes.shape[1])]
    trees = [
        f"{_number(weight)} * {_case(tree.rootNode(), names)}"
        for tree, weight in zip(regressor._call_java("trees"), regressor.treeWeights, strict=True)
    ]
    _create(spark, f"{name}_trees", names, "(" + " + ".join(trees) + ")")
    components = [_sum(-(mean @ axes[:, k]), axes[:, k], inputs) for k in range(axes.shape[1])]
    _create(spark, name, inputs, f"`{name}_trees`({', '.join(components)})")
    return inputs


def register_linear(spark: SparkSession, name: str, weights: dict[str, float], intercept: float) -> list[str]:
    """A linear scorer as a SQL function."""
    _create(spark, name, list(weights), _sum(intercept, list(weights.values()), list(weights)))
    return list(weights)
