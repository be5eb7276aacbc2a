"""Run records: parameters, metrics, tags and the model of each training run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.ml import regression
from lakeops.operators.sizing import spread
from lakeops.sources.files import literal_rows

_TEXT = T.MapType(T.StringType(), T.StringType())
RUN_SCHEMA = (
    T.StructType()
    .add("experiment_id", T.StringType())
    .add("run_id", T.StringType())
    .add("parent_run_id", T.StringType())
    .add("run_name", T.StringType())
    .add("ts", T.TimestampType())
    .add("params", _TEXT)
    .add("metrics", T.MapType(T.StringType(), T.DoubleType()))
    .add("tags", _TEXT)
    .add("model_path", T.StringType())
)


def search(runs: DataFrame, experiment_id: str, metric: str, max_results: int | None = None) -> DataFrame:
    """Runs of an experiment, best metric first; runs without it last. All of them unless
    ``max_results`` is stated."""
    found = runs.where(F.col("experiment_id") == experiment_id)
    found = found.orderBy(F.col("metrics")[metric].desc_nulls_last(), "run_id")
    return found if max_results is None else found.limit(max_results)


@dataclass
class RunLog:
    """An append-only folder of run records, with models saved beside it."""

    spark: SparkSession
    path: str

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def runs(self) -> DataFrame:
        reader = self.spark.read.schema(RUN_SCHEMA).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.path}/runs")

    def record(
        self,
        experiment_id: str,
        params: dict,
        metrics: dict[str, float],
        tags: dict[str, str] | None = None,
        model: PipelineModel | None = None,
        run_name: str | None = None,
        parent_run_id: str | None = None,
    ) -> str:
        run_id = uuid.uuid4().hex
        model_path = None
        if model is not None:
            model_path = f"{self.path}/models/{run_id}"
            model.write().save(model_path)
        row = (
            experiment_id,
            run_id,
            parent_run_id,
            run_name,
            datetime.now(timezone.utc),
            [(k, str(v)) for k, v in params.items()],
            [(k, float(v)) for k, v in metrics.items()],
            [*(tags or {}).items(), ("run_id", run_id)],
            model_path,
        )
        # A folder per run: runs recorded at the same time do not meet.
        literal_rows(self.spark, [row], RUN_SCHEMA).write.parquet(f"{self.path}/runs/run={run_id}")
        return run_id

    def model(self, run_id: str) -> PipelineModel:
        found = self.runs().where(F.col("run_id") == run_id).select("model_path").first()
        if found is None or found.model_path is None:
            raise LookupError(f"no model recorded for run {run_id}")
        return PipelineModel.load(found.model_path)


def run_training(
    log: RunLog,
    experiment_id: str,
    train_df: DataFrame,
    test_df: DataFrame,
    label: str,
    features: list[str],
    regressor,
    components: int,
    params: dict,
    table_name: str = "",
    table_version: int | None = None,
    run_name: str | None = None,
    parent_run_id: str | None = None,
) -> tuple[str, PipelineModel, dict[str, float]]:
    """Fit, measure on both parts and record the run with the data's version."""
    used = [*features, label]
    # Held: a source that joins or shuffles is read once for all passes.
    with regression.kept(spread(regression.used(train_df, used, regressor))) as rows:
        model = regression.fit(rows, features, regressor, components)
        metrics = regression.evaluate(model, rows.select(used), test_df.select(used), label)
    stated = {
        "n_components": components,
        **params,
        "algo_name": type(regressor).__name__,
        "table_name": table_name,
        "table_version": table_version,
    }
    run_id = log.record(
        experiment_id, stated, metrics, {"features": ",".join(features)}, model, run_name, parent_run_id
    )
    return run_id, model, metrics
