"""Random search over model settings, trials running side by side."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from lakeops import scratch
from lakeops.ml import regression
from lakeops.ml.runs import RunLog
from lakeops.operators.sizing import spread
from lakeops.sources.files import literal_rows

METRICS = [f"{part}_{name}" for part in ("train", "test") for name in ("mse", "mae", "rmse", "r2")]
TRIAL_SCHEMA = (
    "trial long, n_components long, max_depth long, learning_rate double, n_estimators long, loss double, "
    + ", ".join(f"{name} double" for name in METRICS)
)


@dataclass(frozen=True)
class Space:
    """Choices per setting. The default ranges of the search."""

    n_components: Sequence[int] = tuple(range(4, 12))
    max_depth: Sequence[int] = tuple(range(3, 8))
    learning_rate: Sequence[float] = tuple(round(0.01 * i, 2) for i in range(1, 15))
    n_estimators: Sequence[int] = range(500, 2000)

    def size(self) -> int:
        return math.prod(len(getattr(self, name)) for name in Space.__dataclass_fields__)

    def at(self, place: int) -> dict:
        """The settings at a place in the product of all choices."""
        settings = {}
        for name in Space.__dataclass_fields__:
            choices = getattr(self, name)
            place, own = divmod(place, len(choices))
            settings[name] = choices[own]
        return settings

    def draws(self, count: int, seed: int) -> list[dict]:
        """Different settings, drawn without replacement; all of them where there are fewer."""
        places = random.Random(seed).sample(range(self.size()), min(count, self.size()))
        return [self.at(place) for place in places]


def _recorded(log: RunLog | None, experiment_id: str, parent_run_id: str | None, draws: list[dict]) -> dict[int, dict]:
    """Metrics of trials whose records are already there, by number."""
    if log is None or parent_run_id is None or not log.exists():
        return {}
    mine = log.runs().where((F.col("experiment_id") == experiment_id) & (F.col("parent_run_id") == parent_run_id))
    found = {}
    # As many rows as trials.
    for row in mine.where(F.col("tags")["trial"].isNotNull()).select("params", "metrics", "tags").collect():
        number = int(row["tags"]["trial"])
        if number < len(draws) and row["params"] == {k: str(v) for k, v in draws[number].items()}:
            found[number] = row["metrics"]
    return found


def search(
    train_df: DataFrame,
    test_df: DataFrame,
    features: Sequence[str],
    label: str,
    space: Space,
    max_evals: int = 8,
    parallelism: int = 4,
    seed: int = 42,
    log: RunLog | None = None,
    experiment_id: str = "",
    parent_run_id: str | None = None,
) -> DataFrame:
    """One row per trial with its settings, its loss (held-out rmse) and all errors of both parts.

    Every trial is a distributed fit over the same two persisted parts; threads only
    keep several of them submitted. Trials with as many components share their projection
    and the cells boosting works on. The trials table has ``max_evals`` rows. With a
    ``log`` every trial is recorded under ``parent_run_id`` when it ends. A search started
    again under the same parent, space and seed takes recorded trials from there and runs
    only the others, so it goes on where a failure ended it.
    """
    scratch.root(train_df.sparkSession)
    draws = space.draws(max_evals, seed)
    results = _recorded(log, experiment_id, parent_run_id, draws)
    missing = [i for i in range(len(draws)) if i not in results]
    columns = [*features, label]
    parts = [spread(p.select(*columns)).persist(StorageLevel.MEMORY_AND_DISK) for p in (train_df, test_df)]
    shared: dict[int, tuple[PipelineModel, DataFrame]] = {}

    def share(components: int) -> None:
        projection = regression.fit_components(parts[0], features, components)
        found = regression.cells(projection.transform(parts[0]), regression.boosted_trees(label))
        shared[components] = projection, found.persist(StorageLevel.MEMORY_AND_DISK)

    def trial(number: int) -> dict[str, float]:
        draw = draws[number]
        settings = {k: draw[k] for k in ("max_depth", "learning_rate", "n_estimators")}
        projection, found = shared[draw["n_components"]]
        boosted = regression.fit_on_cells(found, regression.boosted_trees(label, **settings, seed=seed))
        model = PipelineModel([*projection.stages, boosted])
        metrics = regression.evaluate(model, *parts, label)
        if log is not None:
            tags = {"features": ",".join(features), "trial": str(number)}
            log.record(experiment_id, draw, metrics, tags, model, parent_run_id=parent_run_id)
        return metrics

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            prepare = inheritable_thread_target(train_df.sparkSession)(share)
            list(pool.map(prepare, sorted({draws[i]["n_components"] for i in missing})))
            run = inheritable_thread_target(train_df.sparkSession)(trial)
            results.update(zip(missing, pool.map(run, missing), strict=True))
    finally:
        for held in [*parts, *[found for _, found in shared.values()]]:
            held.unpersist()
    rows = [
        (i, *draw.values(), results[i]["test_rmse"], *[results[i][m] for m in METRICS]) for i, draw in enumerate(draws)
    ]
    return literal_rows(train_df.sparkSession, rows, TRIAL_SCHEMA)


def best(trials: DataFrame) -> DataFrame:
    """The settings with the least error, as values."""
    return trials.orderBy(F.col("loss").asc_nulls_last(), "trial").limit(1)
