"""Models, tuning, scoring and run records."""

from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from lakeops.ml import attribution, regression, runs, scoring, tuning
from lakeops.operators import sampling
from lakeops.sources import views

FEATURES = views.PRICE_FEATURES


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    train, test = sampling.train_test_split(views.price(spark, sf_dir), views.PRICE_KEYS)
    return train, test


def test_draws_are_seeded_distinct_and_in_range():
    space = tuning.Space()
    draws = space.draws(16, 1)
    assert draws == space.draws(16, 1) != space.draws(16, 2)
    assert len({tuple(d.values()) for d in draws}) == 16
    for d in draws:
        assert 4 <= d["n_components"] <= 11 and 3 <= d["max_depth"] <= 7
        assert 0.01 <= d["learning_rate"] <= 0.14 and 500 <= d["n_estimators"] < 2000
    small = tuning.Space((2,), (3,), (0.1,), (5, 6)).draws(4, 0)
    assert sorted(d["n_estimators"] for d in small) == [5, 6]
    every = tuning.Space((2, 3), (3, 4, 5), (0.1,), (5, 6))
    assert len({tuple(d.values()) for d in every.draws(99, 3)}) == every.size() == 12


def test_trials_are_recorded_under_their_parent(spark, parts, path):
    log = runs.RunLog(spark, path)
    space = tuning.Space((2, 3), (2,), (0.2,), (2, 3))
    trials = tuning.search(*parts, FEATURES, "price", space, 3, log=log, experiment_id="e", parent_run_id="p")
    best = tuning.best(trials).first()
    found = runs.search(log.runs(), "e", "test_rmse").collect()
    assert [r.parent_run_id for r in found] == ["p"] * 3
    assert min(r.metrics["test_rmse"] for r in found) == best.loss
    assert sorted(int(r.params["n_components"]) for r in found) == sorted(r.n_components for r in trials.collect())


def test_run_record(spark, parts, path):
    log = runs.RunLog(spark, path)
    regressor = regression.elastic_net(parts[0], "price", 0.05, 0.1)
    run_id, model, metrics = runs.run_training(
        log, "e1", *parts, "price", FEATURES, regressor, 3, {"alpha": 0.05}, "prices", 4, "first"
    )
    row = log.runs().first()
    assert (row.run_id, row.experiment_id, row.run_name) == (run_id, "e1", "first")
    assert row.params == {
        "n_components": "3", "alpha": "0.05", "algo_name": "LinearRegression", "table_name": "prices", "table_version": "4",
    }
    assert set(row.metrics) == {f"{p}_{m}" for p in ("train", "test") for m in ("mse", "mae", "rmse", "r2")}
    assert row.tags["features"] == ",".join(FEATURES)
    with pytest.raises(LookupError):
        log.model("nobody")


def test_metrics_against_numpy(spark, parts):
    model = regression.train(parts[0], FEATURES, regression.elastic_net(parts[0], "price", 0.05, 0.1), 3)
    metrics = regression.evaluate(model, *parts, "price")
    rows = np.array(model.transform(parts[1]).select("price", "prediction").collect(), dtype=float)
    error = rows[:, 0] - rows[:, 1]
    assert metrics["test_mse"] == pytest.approx((error**2).mean())
    assert metrics["test_mae"] == pytest.approx(abs(error).mean())
    assert metrics["test_r2"] == pytest.approx(1 - (error**2).sum() / ((rows[:, 0] - rows[:, 0].mean()) ** 2).sum())


@pytest.mark.parametrize(
    "errors, patience, wanted",
    [
        ([5.0, 4.0, 3.0, 2.0], 2, (4, 4)),
        ([5.0, 3.0, 4.0, 4.0, 1.0], 2, (2, 4)),
        ([5.0, 3.0, 4.0, 4.0, 1.0], 3, (5, 5)),
        ([2.0, 2.0, 2.0, 2.0], 3, (1, 4)),
        ([1.0], 1, (1, 1)),
        ([3.0, 2.0, 2.5, 1.5, 1.6, 1.7], 2, (4, 6)),
    ],
)
def test_best_round(errors, patience, wanted):
    assert regression.best_round(errors, patience) == wanted


def test_patience_keeps_the_best_round(parts):
    """On labels that are half noise the held-out error rises again; the cut model is the
    ensemble of the best round, and its error is the one recorded for it."""
    noise = F.pmod(F.xxhash64(*views.PRICE_KEYS, "qty"), F.lit(1000)) / 10
    flagged = parts[0].withColumn("held", F.col("l_linenumber") == 1).withColumn("price", F.col("price") / 4 + noise)
    trees = regression.boosted_trees("price", max_depth=5, learning_rate=0.8, n_estimators=15)
    stopped = regression.fit_with_patience(flagged, "held", FEATURES, trees, 2, patience=3)
    assert len(stopped.errors) == 15 and stopped.stopped_after < 15
    assert stopped.best_round == 1 + int(np.argmin(stopped.errors[: stopped.stopped_after]))
    cut = stopped.model.stages[-1]
    assert len(cut.trees) == stopped.best_round and list(cut.treeWeights) == [1.0] + [0.8] * (stopped.best_round - 1)
    held = stopped.model.transform(flagged.where("held"))
    error = held.agg(F.avg(F.pow(F.col("price") - F.col("prediction"), 2))).first()[0]
    assert error == pytest.approx(stopped.errors[stopped.best_round - 1])


def test_cut_model_is_saved_and_loaded(spark, parts, path):
    flagged = parts[0].withColumn("held", F.col("l_linenumber") == 1)
    trees = regression.boosted_trees("price", n_estimators=4)
    model = regression.fit_with_patience(flagged, "held", FEATURES, trees, 2, patience=2).model
    model.write().save(path)
    again = PipelineModel.load(path)
    before, after = ([r[0] for r in m.transform(parts[1]).select("prediction").collect()] for m in (model, again))
    assert before == after


def test_search_goes_on_from_its_records(spark, parts, path):
    space = tuning.Space((2, 3), (2,), (0.2, 0.3), (2, 3))
    whole = tuning.search(*parts, FEATURES, "price", space, 4)
    log = runs.RunLog(spark, path)
    tuning.search(*parts, FEATURES, "price", space, 2, log=log, experiment_id="e", parent_run_id="p")
    first = {r.run_id for r in log.runs().collect()}
    again = tuning.search(*parts, FEATURES, "price", space, 4, log=log, experiment_id="e", parent_run_id="p")
    assert log.runs().count() == 4 and first < {r.run_id for r in log.runs().collect()}
    for mine, wanted in zip(again.orderBy("trial").collect(), whole.orderBy("trial").collect(), strict=True):
        assert list(mine[:5]) == list(wanted[:5])
        assert list(mine[5:]) == pytest.approx(list(wanted[5:]))
    assert set(tuning.METRICS) < set(again.columns)


def test_compiled_models_equal_their_transform(spark, parts):
    """Scoring functions are plain expressions: no Python in the plan, null for a null input."""
    train, test = parts
    for name, regressor in (
        ("line_model", regression.elastic_net(train, "price", 0.05, 0.1)),
        ("tree_model", regression.boosted_trees("price", max_depth=4, n_estimators=12)),
    ):
        model = regression.train(train, FEATURES, regressor, 3)
        inputs = scoring.register_model(spark, name, model)
        assert inputs == FEATURES
        model.transform(test).createOrReplaceTempView("scored_rows")
        out = spark.sql(f"SELECT prediction, {name}({', '.join(inputs)}) AS again FROM scored_rows")
        assert out.where("abs(prediction - again) > 1e-9 OR again IS NULL").isEmpty()
        again = spark.sql(f"SELECT {name}({', '.join(inputs)}) AS again FROM scored_rows")
        plan = spark.sql(f"SELECT {name}(1.0, NULL, 0.1, 3.0) AS p")
        for df in (again, plan):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "Python" not in text and "Arrow" not in text
        assert plan.first().p is None


def test_large_tree_models_are_refused(spark, parts, monkeypatch):
    model = regression.train(parts[0], FEATURES, regression.boosted_trees("price", n_estimators=3), 2)
    monkeypatch.setattr(scoring, "MAX_LEAVES", 10)
    with pytest.raises(ValueError, match="leaves"):
        scoring.register_model(spark, "too_large", model)


def test_one_timestamp_per_batch(spark, parts):
    before = datetime.now(timezone.utc).timestamp()
    batch = scoring.score_batch(parts[1], views.linear_score(), "price")
    assert batch.columns == ["price", "prediction", "ts"]
    times = batch.select("ts").distinct().collect()
    assert len(times) == 1 and batch.select(F.unix_micros("ts")).first()[0] / 1e6 >= before - 1


def test_only_known_models_become_sql_functions(spark, parts):
    model = regression.train(parts[0], FEATURES, DecisionTreeRegressor(labelCol="price", maxDepth=2), 2)
    with pytest.raises(TypeError):
        scoring.register_model(spark, "nope", model)


def test_drift_steps_zero_one_more_column_each(spark, sf_dir):
    steps = scoring.drift_steps(views.price(spark, sf_dir), views.DRIFT_ORDER)
    sums = [tuple(s.agg(*[F.sum(c) for c in views.DRIFT_ORDER]).first()) for s in steps]
    assert [[v == 0 for v in row] for row in sums] == [
        [False, False, False], [True, False, False], [True, True, False], [True, True, True],
    ]


def test_components_equal_a_plain_decomposition(spark, sf_dir):
    vectors = views.table(spark, sf_dir, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("raw")
    )
    x = np.stack([r.raw.toArray() for r in vectors.collect()])
    values, axes = np.linalg.eigh(np.cov(x.T))
    for partitions in (2, 8):
        model = regression.fit_components(vectors.repartition(partitions), "raw", 5)
        assert np.allclose(model.stages[-1].explainedVariance.toArray(), values[::-1][:5] / values.sum())
        found = model.stages[-1].pc.toArray()
        assert np.allclose(np.abs((found * axes[:, ::-1][:, :5]).sum(axis=0)), 1)
        assert (np.take_along_axis(found, np.abs(found).argmax(axis=0)[None], axis=0) > 0).all()


def test_search_gives_all_runs(spark):
    rows = [("e", f"r{i:05d}", {"m": float(i % 50)}) for i in range(1500)]
    log = spark.createDataFrame(rows, "experiment_id string, run_id string, metrics map<string, double>")
    assert runs.search(log, "e", "m").count() == 1500
    assert runs.search(log, "e", "m", max_results=7).count() == 7


def test_background_does_not_depend_on_partitions(spark, sf_dir):
    price = views.price(spark, sf_dir)
    found = [
        sorted(tuple(round(v, 9) for v in r) for r in attribution.background(price.repartition(n), ["ext", "disc"]).drop("cluster").collect())
        for n in (2, 9)
    ]
    assert found[0] == found[1]


def test_background_on_values_of_the_data(spark, sf_dir):
    """Each coordinate of a cluster's mean moves to the value a search of all values finds."""
    price = views.price(spark, sf_dir).select("qty", "disc")
    values = {f: sorted({float(r[f]) for r in price.select(f).collect()}) for f in price.columns}
    means = attribution.background(price, ["qty", "disc"], k=6)
    plain = sorted(
        (r.weight, *[min(values[f], key=lambda v: (abs(v - r[f]), v)) for f in ("qty", "disc")]) for r in means.collect()
    )
    for n in (2, 8):
        moved = attribution.background(price.repartition(n), ["qty", "disc"], k=6, on_values=True)
        assert sorted((r.weight, r.qty, r.disc) for r in moved.collect()) == plain


def test_nearest_values_of_odd_columns(spark):
    points = spark.createDataFrame([(0, 3, 2.5, -9.0), (1, 1, 99.0, 4.0)], "cluster int, weight long, a double, b double")
    df = spark.createDataFrame([(2, 4.0), (3, None), (None, 5.0), (2, float("nan"))], "a int, b double")
    found = sorted(tuple(r) for r in attribution.nearest_values(points, df, ["a", "b"]).collect())
    # Of two values as near the smaller; nulls and NaN are no values.
    assert found == [(0, 3, 2.0, 4.0), (1, 1, 3.0, 4.0)]


def test_boosting_on_cells_is_boosting_on_all_rows(spark, monkeypatch):
    """Where features have few values both see the same thresholds; the cells do not grow with the rows."""
    df = spark.range(3000).select(
        (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * F.col("id") % 11).cast("double").alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) + (F.col("id") % 7) * (F.col("id") * F.col("id") % 11)).cast("double").alias("y"),
    )
    trees = regression.boosted_trees("y", n_estimators=12)
    model = regression.train(df, ["a", "b"], trees, 2)
    projected = PipelineModel(model.stages[:-1]).transform(df)
    # Distinct values of a rotated component are more than bins, so the plain fit gets the bins themselves.
    assembled = regression.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    mine = regression.fit_on_cells(regression.cells(assembled, trees), trees).transform(assembled)
    plain = trees.fit(assembled).transform(assembled)
    key = ["a", "b"]
    both = mine.groupBy(key).agg(F.max("prediction").alias("mine")).join(plain.groupBy(key).agg(F.max("prediction").alias("plain")), key)
    assert both.where("abs(mine - plain) > 1e-9").isEmpty() and both.count() == mine.select(key).distinct().count()
    for rows in (assembled, assembled.unionByName(assembled)):
        found = regression.cells(rows, trees)
        assert found.count() == both.count() and found.agg(F.sum("_rows")).first()[0] == rows.count()
    # Every row falls into the cell it was counted in: leaves predict the mean of their rows.
    assert model.transform(df).agg(F.avg("prediction") - F.avg("y")).first()[0] == pytest.approx(0, abs=1e-9)
    assert projected.count() == 3000 and not model.stages[-1].isSet("weightCol") and model.stages[-1].getMaxBins() == 32


def test_rounds_pass_over_no_more_cells_than_bins_allow(spark, monkeypatch):
    """Features of as many values as rows: more rows make no more cells, and every row counts in one."""
    passed, boost = [], regression.GBTRegressor.fit

    def counted(self, df, *args):
        weight = F.sum(self.getWeightCol()) if self.isDefined("weightCol") else F.lit(None)
        passed.append(tuple(df.agg(F.count(F.lit(1)), weight).first()))
        return boost(self, df, *args)

    monkeypatch.setattr(regression.GBTRegressor, "fit", counted)
    trees = regression.boosted_trees("y", n_estimators=3)
    trees.setMaxBins(8)
    for count in (2000, 8000):
        df = spark.range(count).select(
            (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1000).alias("a"), (F.col("id") / count).alias("b"), (F.col("id") % 5 == 0).alias("held")
        ).withColumn("y", F.col("a") * F.col("b"))
        regression.train(df, ["a", "b"], trees, 2)
        regression.fit_with_patience(df, "held", ["a", "b"], trees, 2, patience=2)
    assert [rows for _, rows in passed] == [2000, 1600, 8000, 6400]
    assert all(found <= 8**2 for found, _ in passed)


def test_cells_refuse_missing_labels(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None)], "a double, y double")
    with pytest.raises(Exception, match="null or NaN"):
        regression.train(df, ["a"], regression.boosted_trees("y", n_estimators=2), 1)


def test_trials_share_projection_and_cells(parts, monkeypatch):
    made, cells = [], regression.cells
    monkeypatch.setattr(regression, "cells", lambda *a: made.append(1) or cells(*a))
    space = tuning.Space((2,), (2,), (0.2, 0.3), (2, 3))
    assert tuning.search(*parts, FEATURES, "price", space, 4).count() == 4
    assert len(made) == 1


def test_a_run_reads_its_source_once(spark, path):
    """Training and measuring pass over the held rows; the source behind them is worked out once a part."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(400).selectExpr("CAST(id % 13 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST(id % 13 + id % 5 AS DOUBLE) AS y")
    source = df.mapInArrow(counted, df.schema)
    regressor = regression.elastic_net(df, "y", 0.05, 0.1)
    runs.run_training(runs.RunLog(spark, path), "e", source, source, "y", ["a", "b"], regressor, 2, {})
    assert seen.value <= 2 * 400
