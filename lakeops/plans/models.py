"""Training, tuning, attribution, scoring, drift and run records over the given tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import scratch
from lakeops.ml import attribution, regression, runs, scoring, tuning
from lakeops.operators import sampling, stats
from lakeops.operators.sizing import spread
from lakeops.plans import texts
from lakeops.plans.texts import with_
from lakeops.sources import views
from lakeops.sources.files import literal_rows
from lakeops.streaming.aggregates import refreshed, running_rmse
from lakeops.tables.versioned import VersionedTable

FEATURES = views.PRICE_FEATURES
SCORED = list(views.SCORER_WEIGHTS)
BATCH_TS = datetime(2024, 1, 1, tzinfo=timezone.utc)
EMBEDDING_SIZE = 64
# The drift monitor: scoring runs, the error from which on a model is trained anew, and
# state stores for a row a run.
DRIFT_RUNS = 5
DRIFT_BOUND = 10.0
MONITOR_STATES = 2


def parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return sampling.train_test_split(views.price(spark, d), views.PRICE_KEYS)


def part_sizes(train: DataFrame, test: DataFrame) -> DataFrame:
    both = train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
    return both.groupBy("part").agg(F.count("*").alias("rows"))


# -- fitting --------------------------------------------------------------------


def pca_project(spark: SparkSession, d: str) -> DataFrame:
    """Projection on every component keeps each centred vector's length."""
    vectors = views.table(spark, d, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("raw")
    )
    model = regression.fit_components(vectors, "raw", EMBEDDING_SIZE)
    axes = vector_to_array("features")
    squares = F.aggregate(axes, F.lit(0.0), lambda total, x: total + x * x)
    return model.transform(vectors).select("vec_id", F.round(squares, 4).alias("squared_length"))


def pca_variance(spark: SparkSession, d: str) -> DataFrame:
    """The price features' first component: its share of the variance and its axis."""
    train, _ = parts(spark, d)
    fitted = regression.fit_components(train, FEATURES, 2).stages[-1]
    axis = fitted.pc.toArray()[:, 0].tolist()
    rows = train.agg(F.count("*").alias("rows"))
    return rows.select(
        "rows",
        F.round(F.lit(float(fitted.explainedVariance[0])), 5).alias("share"),
        *[F.round(F.lit(value), 4).alias(f"on_{name}") for name, value in zip(FEATURES, axis, strict=True)],
    )


def elastic_net_fit(spark: SparkSession, d: str) -> DataFrame:
    """Coefficients of the penalised fit, one row per feature, and the intercept."""
    data = views.price(spark, d)
    assembled = regression.VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data)
    model = regression.elastic_net(data, "price", alpha=0.05, l1_ratio=0.1).fit(assembled)
    named = [*zip(FEATURES, model.coefficients.toArray().tolist()), ("intercept", model.intercept)]
    rows = [(name, round(value, 4)) for name, value in named]
    return literal_rows(spark, rows, "term string, value double")


def twice_scored(df: DataFrame, first: PipelineModel, second: PipelineModel) -> DataFrame:
    """Predictions of two models side by side, row by row."""
    once = first.transform(df).select(*FEATURES, "price", F.col("prediction").alias("before"))
    both = second.transform(once)
    return both.select("price", F.col("before").alias("prediction"), F.col("prediction").alias("again"))


def gbt_fit(spark: SparkSession, d: str) -> DataFrame:
    """A hundred rounds of boosted trees on components. Every leaf predicts the mean of its
    rows, so over the training rows predictions average what the labels do."""
    train, test = parts(spark, d)
    model = regression.train(train, FEATURES, regression.boosted_trees("price", n_estimators=100), 3)
    mean = train.agg(F.avg("price")).scalar()
    squares = F.sum(F.pow(F.col("price") - F.col("prediction"), 2))
    learned = model.transform(train).agg(F.round(F.avg("prediction"), 6).alias("mean_prediction")).first()[0]
    return model.transform(test).agg(
        F.count("*").alias("rows"),
        F.lit(learned).alias("mean_prediction"),
        (squares < 0.1 * F.sum(F.pow(F.col("price") - mean, 2))).alias("beats_mean"),
    )


def train_model(spark: SparkSession, d: str) -> DataFrame:
    """Components then elastic net, as one model; held-out errors from plain aggregates."""
    train, test = parts(spark, d)
    regressor = regression.elastic_net(train, "price", alpha=0.05, l1_ratio=0.1)
    model = regression.train(train, FEATURES, regressor, 3)
    out = stats.regression_metrics(model.transform(test), "price", "prediction")
    return out.select(F.round("test_r2", 6).alias("test_r2"), F.round("test_rmse", 4).alias("test_rmse"))


def train_eval(spark: SparkSession, d: str) -> DataFrame:
    """A hundred rounds of boosted trees, cut after the best on held-out rows (patience ten);
    both parts measured by one pass. Mean square error over 1 - r2 is a part's variance."""
    train, test = parts(spark, d)
    held_out = sampling.key_bucket(views.PRICE_KEYS, sampling.PRICE_KEY_FACTORS, 8) == 1
    flagged = spread(train.withColumn("held_out", held_out))
    trees = regression.boosted_trees("price", n_estimators=100, learning_rate=0.3)
    stopped = regression.fit_with_patience(flagged, "held_out", FEATURES, trees, 3, patience=10)
    metrics = regression.evaluate(stopped.model, train, test, "price")
    rows = [
        (
            p,
            round(metrics[f"{p}_mse"] / (1 - metrics[f"{p}_r2"]), 4),
            metrics[f"{p}_r2"] > 0.99 and metrics[f"{p}_mae"] <= metrics[f"{p}_rmse"],
            stopped.errors[stopped.best_round - 1] == min(stopped.errors[: stopped.stopped_after]),
        )
        for p in ("train", "test")
    ]
    measured = literal_rows(spark, rows, "part string, variance double, fits boolean, kept_best boolean")
    return part_sizes(train, test).join(F.broadcast(measured), "part")


def tune_random(spark: SparkSession, d: str) -> DataFrame:
    """Eight seeded draws without replacement; each trial's errors give the variance of both
    parts, and the reported settings are the trial with the least error."""
    train, test = parts(spark, d)
    space = tuning.Space(n_components=(2, 3, 4), max_depth=(2, 3), learning_rate=(0.1, 0.2, 0.3), n_estimators=(10, 15, 20))
    trials = tuning.search(train, test, FEATURES, "price", space, max_evals=8)
    chosen = tuning.best(trials).select(F.col("trial").alias("best"), F.col("loss").alias("best_loss"))
    settings = F.struct("n_components", "max_depth", "learning_rate", "n_estimators")

    def variance(part: str) -> Column:
        return F.round(F.col(f"{part}_mse") / (1 - F.col(f"{part}_r2")), 4)

    return trials.join(F.broadcast(chosen), F.col("trial") == F.col("best"), "left").agg(
        F.count("loss").alias("trials"),
        F.count_distinct(settings).alias("settings"),
        F.max(variance("train")).alias("train_variance"),
        F.min(variance("test")).alias("test_variance"),
        (F.max("best_loss") == F.min("loss")).alias("least_loss"),
    )


def model_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A recorded model, fetched by run id, predicts what it predicted before."""
    train, test = parts(spark, d)
    regressor = regression.elastic_net(train, "price", alpha=0.05, l1_ratio=0.1)
    log = runs.RunLog(spark, scratch.fresh(spark, "runs"))
    run_id, model, _ = runs.run_training(log, "e1", train, test, "price", FEATURES, regressor, 3, {"alpha": 0.05})
    return twice_scored(test, model, log.model(run_id)).agg(
        F.count("*").alias("rows"), F.count(F.when(F.col("prediction") != F.col("again"), 1)).alias("different")
    )


# -- attribution ----------------------------------------------------------------


def kmeans_background(spark: SparkSession, d: str) -> DataFrame:
    points = attribution.background(views.price(spark, d), SCORED)
    return points.select("cluster", "weight", *[F.round(f, 4).alias(f) for f in SCORED])


def kmeans_background_mean(spark: SparkSession, d: str) -> DataFrame:
    """The weighted mean of the background is the mean of the data."""
    points = attribution.background(views.price(spark, d), SCORED)
    return points.agg(
        F.sum("weight").alias("rows"),
        F.count("*").alias("points"),
        *[F.round(F.sum(F.col(f) * F.col("weight")) / F.sum("weight"), 4).alias(f) for f in SCORED],
    )


def kmeans_background_values(spark: SparkSession, d: str) -> DataFrame:
    """Rows and points of a background on real values, and coordinates that are none."""
    data = views.price(spark, d)
    points = attribution.background(data, SCORED, on_values=True)
    cells = points.unpivot(["cluster", "weight"], SCORED, "feature", "value")
    held = data.select(*[F.col(f).cast("double").alias(f) for f in SCORED]).unpivot([], SCORED, "feature", "value")
    # At most MAX_POINTS points, so as many cells a feature.
    strange = cells.join(
        held.join(F.broadcast(cells.select("feature", "value").distinct()), ["feature", "value"], "left_semi").distinct(),
        ["feature", "value"],
        "left_anti",
    )
    counted = cells.groupBy("feature").agg(F.sum("weight").alias("rows"), F.count("*").alias("points"))
    missing = strange.groupBy("feature").agg(F.count("*").alias("n"))
    return counted.join(missing, "feature", "left").select(
        "feature", "rows", "points", F.coalesce("n", F.lit(0)).alias("no_values")
    )


def _linear_shares(spark: SparkSession, d: str) -> DataFrame:
    data = views.price(spark, d)
    return attribution.shapley_values(
        sampling.sample_n(data, 10, views.PRICE_KEYS, seed=7),
        views.PRICE_KEYS,
        SCORED,
        attribution.background(data, SCORED),
        scoring.predictor(views.linear_score()),
    )


def shapley_values(spark: SparkSession, d: str) -> DataFrame:
    return _linear_shares(spark, d).select(*views.PRICE_KEYS, "feature", F.round("phi", 4).alias("phi"))


def shapley_mean(spark: SparkSession, d: str) -> DataFrame:
    out = attribution.mean_importance(_linear_shares(spark, d))
    return out.select(
        "feature", F.round("mean_shap", 4).alias("mean_shap"), F.round("mean_abs_shap", 4).alias("mean_abs_shap")
    )


def shapley_model(spark: SparkSession, d: str) -> DataFrame:
    """Shares of a trained tree model sum to its prediction minus the background's."""
    train, test = parts(spark, d)
    model = regression.train(train, FEATURES, regression.boosted_trees("price", n_estimators=20), 3)
    points = attribution.background(train, FEATURES)
    sample = sampling.sample_n(test, 10, views.PRICE_KEYS, seed=7)
    shares = attribution.shapley_values(sample, views.PRICE_KEYS, FEATURES, points, scoring.predictor(model))
    base = (
        model.transform(points).agg((F.sum(F.col("prediction") * F.col("weight")) / F.sum("weight"))).scalar()
    )
    whole = model.transform(sample).select(*views.PRICE_KEYS, (F.col("prediction") - base).alias("whole"))
    return (
        shares.groupBy(*views.PRICE_KEYS)
        .agg(F.sum("phi").alias("total"))
        .join(whole, views.PRICE_KEYS)
        .select(*views.PRICE_KEYS, (F.abs(F.col("total") - F.col("whole")) < 1e-6).alias("adds_up"))
    )


# -- scoring and drift ----------------------------------------------------------


def score_batch(spark: SparkSession, d: str) -> DataFrame:
    out = scoring.score_batch(views.price(spark, d), views.linear_score(), "price", BATCH_TS)
    return out.select(
        F.round("price", 10).alias("price"),
        F.round("prediction", 8).alias("prediction"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
    )


def score_udf_sql(spark: SparkSession, d: str) -> DataFrame:
    """A registered scorer called from SQL text."""
    name = f"price_score_{uuid.uuid4().hex}"
    inputs = scoring.register_linear(spark, name, views.SCORER_WEIGHTS, views.SCORER_INTERCEPT)
    views.price(spark, d).createOrReplaceTempView(f"{name}_rows")
    scored = spark.sql(f"SELECT *, {name}({', '.join(inputs)}) AS prediction FROM {name}_rows")
    return scored.select(*views.PRICE_KEYS, F.round("prediction", 8).alias("prediction"))


def score_model_sql(spark: SparkSession, d: str) -> DataFrame:
    """Trained models called from SQL text agree with their own transform."""
    train, test = parts(spark, d)
    name = f"price_model_{uuid.uuid4().hex}"
    out = None
    for kind, regressor in (
        ("line", regression.elastic_net(train, "price", alpha=0.05, l1_ratio=0.1)),
        ("trees", regression.boosted_trees("price", n_estimators=20)),
    ):
        model = regression.train(train, FEATURES, regressor, 3)
        inputs = scoring.register_model(spark, f"{name}_{kind}", model)
        model.transform(test).createOrReplaceTempView(f"{name}_{kind}_rows")
        checked = spark.sql(
            f"SELECT '{kind}' AS kind, count(*) AS rows, "
            f"count_if(abs(prediction - {name}_{kind}({', '.join(inputs)})) > 1e-8) AS different "
            f"FROM {name}_{kind}_rows"
        )
        out = checked if out is None else out.unionByName(checked)
    return out


def drift_rmse(spark: SparkSession, d: str) -> DataFrame:
    """Score, zero one more column, score again; error by scoring time."""
    scored = None
    for step, data in enumerate(scoring.drift_steps(views.price(spark, d), views.DRIFT_ORDER)):
        batch = scoring.score_batch(data, views.linear_score(), "price", BATCH_TS + timedelta(hours=step))
        scored = batch if scored is None else scored.unionByName(batch)
    out = stats.rmse_by(scored, "ts", "price", "prediction")
    step = (F.unix_seconds("ts") - int(BATCH_TS.timestamp())) / 3600
    return out.select(step.cast("long").alias("step"), F.round("rmse", 4).alias("rmse"))


def drift_stream(spark: SparkSession, d: str) -> DataFrame:
    """The monitor as it runs: a stream keeps the error of every scoring run over a versioned
    table of predictions while scoring appends to it. Columns are lost one by one; when the
    newest error passes the bound, a model is trained on what is left and recorded, and the
    next run fetches it by its id."""
    train, test = parts(spark, d)
    log = runs.RunLog(spark, scratch.fresh(spark, "drift-runs"))
    steps = list(zip(scoring.drift_steps(train, views.DRIFT_ORDER), scoring.drift_steps(test, views.DRIFT_ORDER), strict=True))

    def retrain(rows: tuple[DataFrame, DataFrame], components: int, parent: str | None) -> str:
        regressor = regression.elastic_net(rows[0], "price", alpha=0.05, l1_ratio=0.1)
        run_id, _, _ = runs.run_training(
            log, "drift", *rows, "price", FEATURES, regressor, components, {"alpha": 0.05}, parent_run_id=parent
        )
        return run_id

    def scored(step: int, run_id: str) -> DataFrame:
        rows = steps[min(step, len(steps) - 1)][1]
        return scoring.score_batch(rows, log.model(run_id), "price", BATCH_TS + timedelta(hours=step))

    models = [retrain(steps[0], len(FEATURES), None)]
    used = [0]
    table = VersionedTable.create(spark, scratch.fresh(spark, "drift-predictions"), scored(0, models[0]))
    errors = running_rmse(table.stream(), "ts", "price", "prediction")
    monitor = refreshed(spark, errors, "drift-monitor", MONITOR_STATES, [table.guard()])
    query = monitor.start(processingTime="0 seconds")
    try:
        for step in range(1, DRIFT_RUNS):
            query.processAllAvailable()
            newest = monitor.latest().agg(F.max_by("rmse", "ts")).first()[0]
            if newest > DRIFT_BOUND:
                lost = min(step - 1, len(steps) - 1)
                models.append(retrain(steps[lost], len(FEATURES) - lost, models[-1]))
            used.append(len(models) - 1)
            table.append(scored(step, models[-1]))
        query.processAllAvailable()
    finally:
        query.stop()
    step = ((F.unix_seconds("ts") - int(BATCH_TS.timestamp())) / 3600).cast("int")
    model = F.element_at(F.array(*[F.lit(n).cast("long") for n in used]), step + 1)
    return monitor.latest().select(step.cast("long").alias("step"), model.alias("model"), F.round("rmse", 4).alias("rmse"))


def retrain_recovers(spark: SparkSession, d: str) -> DataFrame:
    """Error grows as columns are lost, and falls again after training on what is left."""
    train, test = parts(spark, d)
    model = regression.train(train, FEATURES, regression.elastic_net(train, "price", 0.05, 0.1), 4)
    drifted_train = scoring.drift_steps(train, views.DRIFT_ORDER)[-1]
    drifted = scoring.drift_steps(test, views.DRIFT_ORDER)[-1]
    again = regression.train(drifted_train, FEATURES, regression.boosted_trees("price", n_estimators=20), 3)
    stages = {"before": (test, model), "drifted": (drifted, model), "retrained": (drifted, again)}
    scored = None
    for stage, (data, fitted) in stages.items():
        part = scoring.score_batch(data, fitted, "price", BATCH_TS).withColumn("stage", F.lit(stage))
        scored = part if scored is None else scored.unionByName(part)
    errors = stats.rmse_by(scored, "stage", "price", "prediction")
    wide = errors.groupBy().pivot("stage", list(stages)).agg(F.first("rmse"))
    return wide.select(
        F.round("before", 4).alias("before"),
        F.round("drifted", 4).alias("drifted"),
        (F.col("retrained") < F.col("drifted")).alias("recovered"),
    )


# -- run records ----------------------------------------------------------------


def search_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of one experiment, best metric first, those without the metric last."""
    doc = F.col("doc_id")
    records = views.table(spark, d, "labels").select(
        F.concat(F.lit("e"), (doc % 3).cast("string")).alias("experiment_id"),
        F.concat(F.lit("r"), doc.cast("string")).alias("run_id"),
        F.create_map(
            F.lit("test_mse"),
            F.when(doc % 5 != 0, (doc % 97).cast("double")),
            F.lit("test_r2"),
            F.col("quality").cast("double"),
        ).alias("metrics"),
    )
    found = runs.search(records, "e1", "test_mse")
    return found.select("run_id", F.col("metrics")["test_mse"].alias("test_mse"), F.col("metrics")["test_r2"].alias("test_r2"))


def run_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Runs recorded against two versions of a table, joined to its history."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "prices"), views.price(spark, d))
    log = runs.RunLog(spark, scratch.fresh(spark, "runs"))
    for name in ("first", "drifted"):
        train, test = sampling.train_test_split(table.read(), views.PRICE_KEYS)
        regressor = regression.elastic_net(train, "price", alpha=0.05, l1_ratio=0.1)
        runs.run_training(
            log, "e1", train, test, "price", FEATURES, regressor, 3, {"alpha": 0.05, "l1_ratio": 0.1},
            "prices", table.current_version(), name,
        )
        if name == "first":
            table.update((F.col("disc") >= 0.0) & (F.col("l_linenumber") == 1), {"disc": 0.0})
    recorded = log.runs().select(
        "run_name",
        F.col("params")["algo_name"].alias("algo_name"),
        F.col("params")["table_version"].cast("long").alias("version"),
        (F.col("metrics")["test_r2"] > 0.9).alias("fits"),
        F.map_contains_key("metrics", F.lit("train_mae")).alias("has_train"),
        (F.col("tags")["run_id"] == F.col("run_id")).alias("tagged"),
    )
    versions = table.history().select("version", "operation", "rows_added")
    return recorded.join(versions, "version")


def record_runs(spark: SparkSession, d: str) -> DataFrame:
    """A training run and three tuning trials recorded under it."""
    train, test = parts(spark, d)
    log = runs.RunLog(spark, scratch.fresh(spark, "runs"))
    regressor = regression.elastic_net(train, "price", alpha=0.05, l1_ratio=0.1)
    parent, _, _ = runs.run_training(
        log, "e1", train, test, "price", FEATURES, regressor, 3, {"alpha": 0.05}, "prices", 0, "baseline"
    )
    space = tuning.Space(n_components=(2, 3), max_depth=(2,), learning_rate=(0.2, 0.3), n_estimators=(10,))
    tuning.search(
        train, test, FEATURES, "price", space, max_evals=3, log=log, experiment_id="e1", parent_run_id=parent
    )
    kind = F.when(F.col("parent_run_id") == parent, "trial").when(F.col("run_id") == parent, "run")
    return log.runs().groupBy(kind.alias("kind")).agg(
        F.count("*").alias("records"),
        F.sum(F.size("params")).cast("long").alias("params"),
        F.sum(F.size("metrics")).cast("long").alias("metrics"),
        F.count("model_path").alias("models"),
        F.countDistinct("run_id").alias("run_ids"),
    )


QUERIES = {
    "pca_project": pca_project,
    "pca_variance": pca_variance,
    "elastic_net_fit": elastic_net_fit,
    "gbt_fit": gbt_fit,
    "train_model": train_model,
    "train_eval": train_eval,
    "tune_random": tune_random,
    "model_roundtrip": model_roundtrip,
    "kmeans_background": kmeans_background,
    "kmeans_background_mean": kmeans_background_mean,
    "kmeans_background_values": kmeans_background_values,
    "shapley_values": shapley_values,
    "shapley_mean": shapley_mean,
    "shapley_model": shapley_model,
    "score_batch": score_batch,
    "score_udf_sql": score_udf_sql,
    "score_model_sql": score_model_sql,
    "drift_rmse": drift_rmse,
    "drift_stream": drift_stream,
    "retrain_recovers": retrain_recovers,
    "search_runs": search_runs,
    "run_lineage": run_lineage,
    "record_runs": record_runs,
}

_KEYS = ", ".join(views.PRICE_KEYS)


def _elastic_net_sql() -> str:
    """Cyclic coordinate descent on the covariances, as a recursive query."""
    moments = [f"covar_pop({a}, {b}) AS g_{a}_{b}" for a in FEATURES for b in FEATURES]
    moments += [f"covar_pop({a}, price) AS c_{a}" for a in FEATURES]
    moments += [f"avg({a}) AS m_{a}" for a in [*FEATURES, "price"]]
    inner = "SELECT step, " + ", ".join(f"w_{f}" for f in FEATURES) + ", m.* FROM walk, moments m WHERE step < 300"
    for i, f in enumerate(FEATURES):
        others = " + ".join(
            f"g_{f}_{o} * {'n' if j < i else 'w'}_{o}" for j, o in enumerate(FEATURES) if o != f
        )
        pull = f"(c_{f} - ({others}))"
        inner = (
            f"SELECT *, sign({pull}) * greatest(abs({pull}) - CAST(0.005 AS DOUBLE), 0) "
            f"/ (g_{f}_{f} + CAST(0.045 AS DOUBLE)) AS n_{f} FROM ({inner}) AS s{i}"
        )
    step = "SELECT step + 1, " + ", ".join(f"n_{f}" for f in FEATURES) + f" FROM ({inner}) AS last"
    start = "SELECT 0 AS step, " + ", ".join(f"CAST(0 AS DOUBLE) AS w_{f}" for f in FEATURES)
    final = "SELECT * FROM walk WHERE step = 300"
    terms = [f"SELECT '{f}' AS term, round(w_{f}, 4) AS value FROM final" for f in FEATURES]
    line = " - ".join(["m_price", *[f"w_{f} * m_{f}" for f in FEATURES]])
    terms.append(f"SELECT 'intercept', round({line}, 4) FROM final, moments")
    return (
        f"WITH RECURSIVE {texts.PRICE},\nmoments AS (SELECT {', '.join(moments)} FROM price),\n"
        f"walk AS ({start} UNION ALL {step}),\nfinal AS ({final})\n" + " UNION ALL ".join(terms)
    )


def _first_component_sql() -> str:
    """Power iteration on the covariances of the training rows, as a recursive query."""
    cells = ", ".join(f"covar_samp({a}, {b}) AS g_{a}_{b}" for a in FEATURES for b in FEATURES)
    product = {a: "(" + " + ".join(f"g_{a}_{b} * w_{b}" for b in FEATURES) + ")" for a in FEATURES}
    length = "sqrt(" + " + ".join(f"{p} * {p}" for p in product.values()) + ")"
    step = ", ".join(f"{p} / {length} AS w_{a}" for a, p in product.items())
    start = ", ".join(f"CAST(0.5 AS DOUBLE) AS w_{a}" for a in FEATURES)
    total = " + ".join(f"g_{a}_{a}" for a in FEATURES)
    axis = ", ".join(f"round(w_{a}, 4) AS on_{a}" for a in FEATURES)
    return (
        f"WITH RECURSIVE {texts.PRICE},\ntrain AS (SELECT * FROM price WHERE NOT ({texts.IS_TEST})),\n"
        f"moments AS (SELECT count(*) AS rows, {cells} FROM train),\n"
        f"walk AS (SELECT 0 AS step, {start} UNION ALL SELECT step + 1, {step} FROM walk, moments WHERE step < 200)\n"
        f"SELECT rows, round({length} / ({total}), 5) AS share, {axis} FROM walk, moments WHERE step = 200"
    )


def _fit_sql(count: int, zeroed: tuple[str, ...] = (), p: str = "") -> list[str]:
    """The leading components of the training rows' features, some of them being zero, each by
    power iteration on what the ones before leave of the covariances, and the elastic net on
    them: components do not correlate, so every coefficient has a closed form (alpha 0.05, l1
    share 0.1). Common table expressions; ``p`` begins the names of two of them."""
    cells = ", ".join(f"covar_pop({a}, {b}) AS g_{a}_{b}" for a in FEATURES for b in FEATURES)
    means = ", ".join(f"avg({a}) AS m_{a}, covar_pop({a}, price) AS y_{a}" for a in FEATURES)
    own = ", ".join(f"CAST(0 AS DOUBLE) AS {a}" if a in zeroed else a for a in FEATURES)
    ctes = [
        f"{p}train AS (SELECT {own}, price FROM price WHERE NOT ({texts.IS_TEST}))",
        f"{p}left_1 AS (SELECT {cells} FROM {p}train)",
        f"{p}base AS (SELECT {means}, avg(price) AS m_price FROM {p}train)",
    ]
    product = {a: "(" + " + ".join(f"g_{a}_{b} * w_{b}" for b in FEATURES) + ")" for a in FEATURES}
    length = "sqrt(" + " + ".join(f"{p} * {p}" for p in product.values()) + ")"
    step = ", ".join(f"{p} / {length} AS w_{a}" for a, p in product.items())
    # No component is at right angles to this start.
    start = ", ".join(f"CAST({0.5 + 0.1 * i} AS DOUBLE) AS w_{a}" for i, a in enumerate(FEATURES))
    kept = ", ".join(f"w_{a}" for a in FEATURES)
    lines = []
    for k in range(1, count + 1):
        ctes += [
            f"{p}walk_{k} AS (SELECT 0 AS step, {start} UNION ALL SELECT step + 1, {step} FROM {p}walk_{k}, {p}left_{k} WHERE step < 400)",
            f"{p}axis_{k} AS (SELECT {kept}, {length} AS v FROM {p}walk_{k}, {p}left_{k} WHERE step = 400)",
            f"{p}left_{k + 1} AS (SELECT "
            + ", ".join(f"g_{a}_{b} - v * w_{a} * w_{b} AS g_{a}_{b}" for a in FEATURES for b in FEATURES)
            + f" FROM {p}left_{k}, {p}axis_{k})",
        ]
        pull = "(" + " + ".join(f"w_{a} * y_{a}" for a in FEATURES) + ")"
        ctes.append(
            f"{p}line_{k} AS (SELECT "
            + ", ".join(
                f"w_{a} * sign({pull}) * greatest(abs({pull}) - 0.005, 0) / (v + 0.045) AS c_{a}" for a in FEATURES
            )
            + f" FROM {p}axis_{k}, {p}base)"
        )
        lines.append(f"SELECT * FROM {p}line_{k}")
    ctes.append(f"{p}line AS (SELECT " + ", ".join(f"sum(c_{a}) AS c_{a}" for a in FEATURES) + f" FROM ({' UNION ALL '.join(lines)}))")
    return ctes


def _components_sql(count: int) -> str:
    return "WITH RECURSIVE " + ",\n".join([texts.PRICE, *_fit_sql(count)])


def _line_sql(zeroed: tuple[str, ...] = ()) -> str:
    """What that model predicts, some features being zero."""
    return " + ".join(
        ["m_price", *[f"c_{a} * ({'0' if a in zeroed else a} - m_{a})" for a in FEATURES]]
    )


_SAMPLE = (
    "sample AS (SELECT * FROM price ORDER BY md5(concat_ws('|', '7', l_orderkey, l_linenumber, l_partkey, l_suppkey)), "
    f"{_KEYS} LIMIT 10)"
)
_SHARES = "shares AS (" + " UNION ALL ".join(
    f"SELECT {_KEYS}, '{f}' AS feature, CAST({w} AS DOUBLE) * ({f} - (SELECT avg({f}) FROM price)) AS phi FROM sample"
    for f, w in views.SCORER_WEIGHTS.items()
) + ")"
_TEST_ROWS = f"SELECT count(*) AS rows FROM lineitem WHERE {texts.IS_TEST}"

def _drift_sql() -> str:
    """Error of every scoring run: three by the first model, then one by each retrained one."""
    fits = {"a_": (4, 0), "b_": (2, 2), "c_": (1, 3)}
    ctes = [texts.PRICE, f"held AS (SELECT * FROM price WHERE {texts.IS_TEST})"]
    for p, (count, zeroed) in fits.items():
        ctes += _fit_sql(count, tuple(views.DRIFT_ORDER[:zeroed]), p)
    runs_ = []
    for step, p in enumerate(["a_", "a_", "a_", "b_", "c_"]):
        line = _line_sql(tuple(views.DRIFT_ORDER[: min(step, 3)]))
        runs_.append(
            f"SELECT CAST({step} AS BIGINT) AS step, CAST({'abc'.index(p[0])} AS BIGINT) AS model, "
            f"round(sqrt(avg((price - ({line})) * (price - ({line})))), 4) AS rmse FROM held, {p}line, {p}base"
        )
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(runs_)


ORACLES = {
    "pca_project": "WITH cells AS (SELECT vec_id, unnest(range(64)) AS i, "
    "unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings), "
    "means AS (SELECT i, avg(x) AS m FROM cells GROUP BY i) "
    "SELECT vec_id, round(sum((x-m)*(x-m)), 4) AS squared_length FROM cells JOIN means USING (i) GROUP BY vec_id",
    "pca_variance": _first_component_sql(),
    "elastic_net_fit": _elastic_net_sql(),
    "gbt_fit": with_(
        texts.PRICE,
        select=f"SELECT (SELECT count(*) FROM price WHERE {texts.IS_TEST}) AS rows, "
        f"round(avg(price), 6) AS mean_prediction, true AS beats_mean FROM price WHERE NOT ({texts.IS_TEST})",
    ),
    "train_model": f"{_components_sql(3)}\nSELECT round(1 - avg(e * e) / var_pop(price), 6) AS test_r2, "
    f"round(sqrt(avg(e * e)), 4) AS test_rmse FROM (SELECT price, price - ({_line_sql()}) AS e "
    f"FROM price, line, base WHERE {texts.IS_TEST}) AS t",
    "train_eval": with_(
        texts.PRICE,
        select=f"SELECT CASE WHEN {texts.IS_TEST} THEN 'test' ELSE 'train' END AS part, count(*) AS rows, "
        "round(var_pop(price), 4) AS variance, true AS fits, true AS kept_best FROM price GROUP BY 1",
    ),
    "tune_random": with_(
        texts.PRICE,
        select="SELECT CAST(8 AS BIGINT) AS trials, CAST(8 AS BIGINT) AS settings, "
        f"round(var_pop(price) FILTER (NOT ({texts.IS_TEST})), 4) AS train_variance, "
        f"round(var_pop(price) FILTER ({texts.IS_TEST}), 4) AS test_variance, true AS least_loss FROM price",
    ),
    "model_roundtrip": f"SELECT rows, CAST(0 AS BIGINT) AS different FROM ({_TEST_ROWS}) AS t",
    "kmeans_background_mean": with_(
        texts.PRICE,
        select="SELECT count(*) AS rows, CAST(10 AS BIGINT) AS points, "
        + ", ".join(f"round(avg({f}), 4) AS {f}" for f in SCORED)
        + " FROM price",
    ),
    "kmeans_background_values": with_(
        texts.PRICE,
        select=" UNION ALL ".join(
            f"SELECT '{f}' AS feature, count({f}) AS rows, CAST(10 AS BIGINT) AS points, CAST(0 AS BIGINT) AS no_values FROM price"
            for f in SCORED
        ),
    ),
    "shapley_values": with_(
        texts.PRICE, _SAMPLE, _SHARES, select=f"SELECT {_KEYS}, feature, round(phi, 4) AS phi FROM shares"
    ),
    "shapley_mean": with_(
        texts.PRICE,
        _SAMPLE,
        _SHARES,
        select="SELECT feature, round(avg(phi), 4) AS mean_shap, round(avg(abs(phi)), 4) AS mean_abs_shap "
        "FROM shares GROUP BY feature",
    ),
    "shapley_model": with_(
        texts.PRICE,
        f"held AS (SELECT * FROM price WHERE {texts.IS_TEST})",
        select=f"SELECT {_KEYS}, true AS adds_up FROM held ORDER BY "
        f"md5(concat_ws('|', '7', l_orderkey, l_linenumber, l_partkey, l_suppkey)), {_KEYS} LIMIT 10",
    ),
    "score_batch": with_(
        texts.PRICE,
        select=f"SELECT round(price, 10) AS price, round({texts.SCORE}, 8) AS prediction, "
        "'2024-01-01 00:00:00' AS ts FROM price",
    ),
    "score_udf_sql": with_(
        texts.PRICE, select=f"SELECT {_KEYS}, round({texts.SCORE}, 8) AS prediction FROM price"
    ),
    "score_model_sql": f"SELECT kind, rows, CAST(0 AS BIGINT) AS different FROM ({_TEST_ROWS}) AS t "
    "CROSS JOIN (VALUES ('line'), ('trees')) AS k(kind)",
    "drift_rmse": with_(
        texts.PRED,
        select="SELECT batch - 1 AS step, round(sqrt(avg((price-prediction)*(price-prediction))), 4) AS rmse "
        "FROM pred WHERE batch >= 1 GROUP BY batch",
    ),
    "drift_stream": _drift_sql(),
    "retrain_recovers": f"{_components_sql(4)}\nSELECT round(sqrt(avg(e * e)), 4) AS before, "
    "round(sqrt(avg(f * f)), 4) AS drifted, true AS recovered FROM (SELECT "
    f"price - ({_line_sql()}) AS e, price - ({_line_sql(tuple(views.DRIFT_ORDER))}) AS f "
    f"FROM price, line, base WHERE {texts.IS_TEST}) AS t",
    "search_runs": "SELECT concat('r', CAST(doc_id AS VARCHAR)) AS run_id, "
    "CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 97 AS DOUBLE) END AS test_mse, "
    "CAST(quality AS DOUBLE) AS test_r2 FROM labels WHERE doc_id % 3 = 1 "
    "ORDER BY test_mse DESC NULLS LAST, run_id",
    "record_runs": "SELECT 'run' AS kind, CAST(1 AS BIGINT) AS records, CAST(5 AS BIGINT) AS params, "
    "CAST(8 AS BIGINT) AS metrics, CAST(1 AS BIGINT) AS models, CAST(1 AS BIGINT) AS run_ids "
    "UNION ALL SELECT 'trial', 3, 12, 24, 3, 3",
    "run_lineage": "SELECT 'first' AS run_name, 'LinearRegression' AS algo_name, CAST(0 AS BIGINT) AS version, true AS fits, "
    "true AS has_train, true AS tagged, 'CREATE' AS operation, count(*) AS rows_added FROM lineitem UNION ALL "
    "SELECT 'drifted', 'LinearRegression', 1, true, true, true, 'UPDATE', count(*) FROM lineitem WHERE l_linenumber = 1",
}
