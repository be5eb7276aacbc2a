"""Scans, sinks, filters, aggregates, sampling and statistics over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import scratch
from lakeops.functions.scalar import safe_identifier
from lakeops.operators import reshape, sampling, stats
from lakeops.plans import texts
from lakeops.plans.texts import with_
from lakeops.sinks.files import write_parquet, write_partitioned
from lakeops.sources import files, views

ROBUST_STEPS = 2
HISTOGRAM_BINS = 10
CORR_COLUMNS = ["price", *views.PRICE_FEATURES]


# -- sources and sinks ---------------------------------------------------------


def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def scan_csv_positional(spark: SparkSession, d: str) -> DataFrame:
    """Line items written as a headerless 29-column flight file, read back by position."""
    ship = F.col("l_shipdate")
    known = {
        "Year": F.year(ship),
        "Month": F.month(ship),
        "DayofMonth": F.dayofmonth(ship),
        "DayOfWeek": F.weekday(ship) + 1,
        "UniqueCarrier": F.col("l_returnflag"),
        "FlightNumber": F.col("l_orderkey"),
        "Origin": F.col("l_suppkey") % 25,
        "Destination": F.col("l_partkey") % 25,
        # Some fields hold text where a number belongs, as the real files do.
        "Distance": F.when(F.col("l_linenumber") == 1, F.lit("NA")).otherwise(F.col("l_quantity").cast("string")),
    }
    rows = views.table(spark, d, "lineitem").select(
        [known.get(n, F.lit(None)).cast("string").alias(n) for n in files.FLIGHT_COLUMNS]
    )
    path = scratch.fresh(spark, "flights-csv")
    rows.write.csv(path)
    typed = {n: "bigint" for n in ("Year", "Month", "DayofMonth", "DayOfWeek", "FlightNumber", "Origin", "Destination")}
    flights = files.scan_csv_positional(spark, path, files.FLIGHT_COLUMNS, {**typed, "Distance": "double"})
    return flights.groupBy("Year", "Month", "DayOfWeek", "Origin", "UniqueCarrier").agg(
        F.count("*").alias("flights"),
        F.count("Distance").alias("with_distance"),
        F.sum("Distance").alias("distance"),
        F.max("FlightNumber").alias("top_number"),
        F.count("TailNumber").alias("tails"),
    )


def table_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of a partitioned copy of the flights, per origin; sizes vary with the machine."""
    path = scratch.fresh(spark, "flights-files")
    write_partitioned(views.flights(spark, d), path, ["origin"])
    return (
        files.file_inventory(spark, path)
        .groupBy(F.col("origin").cast("long").alias("origin"))
        .agg((F.count("*") > 0).alias("has_files"), (F.sum("size_bytes") > 0).alias("has_bytes"))
    )


def write_parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return write_parquet(views.loan(spark, d), scratch.fresh(spark, "loan"))


def ctas_partitioned(spark: SparkSession, d: str) -> DataFrame:
    written = write_partitioned(views.flights(spark, d), scratch.fresh(spark, "flights"), ["origin"])
    return written.groupBy("origin", "dow").agg(F.count("*").alias("flights"))


def ctas_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Create a catalog table from a query, then read it by name."""
    name = f"lakeops_flights_{uuid.uuid4().hex}"
    path = scratch.fresh(spark, "flights-table")
    views.flights(spark, d).createOrReplaceTempView(f"{name}_src")
    spark.sql(
        f"CREATE TABLE {name} USING parquet PARTITIONED BY (dow) LOCATION '{path}' AS "
        f"SELECT /*+ REBALANCE(dow) */ month, origin, dow FROM {name}_src"
    )
    counts = spark.table(name).groupBy("dow").agg(F.count("*").alias("flights"), F.max("origin").alias("top_origin"))
    counts = write_parquet(counts, scratch.fresh(spark, "flights-counts"))
    spark.sql(f"DROP TABLE {name}")
    spark.catalog.dropTempView(f"{name}_src")
    return counts


# -- projection and filter -----------------------------------------------------


def project_columns(spark: SparkSession, d: str) -> DataFrame:
    return views.loan(spark, d).select("addr_state", "loan_status")


def drop_label(spark: SparkSession, d: str) -> DataFrame:
    return views.price(spark, d).drop("price").select(
        *views.PRICE_KEYS, *[F.round(c, 6).alias(c) for c in views.PRICE_FEATURES]
    )


def head_scored(spark: SparkSession, d: str) -> DataFrame:
    scored = views.price(spark, d).select(*views.PRICE_KEYS, F.round(views.linear_score(), 8).alias("prediction"))
    return scored.orderBy(*views.PRICE_KEYS).limit(10)


def scalar_casts(spark: SparkSession, d: str) -> DataFrame:
    """Truncating cast to long and widening cast to double, on the loan counts."""
    return views.loan_by_state(spark, d).select(
        "addr_state",
        (F.col("cnt") * 0.37).cast("bigint").alias("part"),
        (F.lit(-1.0) * F.col("cnt") * 0.37).cast("bigint").alias("negative_part"),
        (F.col("cnt") * 0.25 * 10000).cast("double").alias("amount"),
    )


def rand_pair(spark: SparkSession, d: str) -> DataFrame:
    """Two uses of one seed draw the same value per row, and null times a draw is null."""
    source = views.loan_by_state(spark, d)
    drawn = source.select(
        "addr_state",
        F.when(F.col("addr_state") != "S20", F.col("cnt")).alias("cnt0"),
    ).select(
        "addr_state",
        "cnt0",
        (F.rand(10) * F.col("cnt0")).cast("bigint").alias("cnt"),
        (F.rand(10) * 10000 * F.col("cnt0")).alias("amount"),
        F.rand(10).alias("r"),
    )
    return drawn.select(
        "addr_state",
        F.coalesce(F.abs(F.col("amount") / 10000 / F.col("cnt0") - F.col("r")) < 1e-9, F.lit(True)).alias("same_draw"),
        (F.col("amount").isNull() == F.col("cnt0").isNull()).alias("null_kept"),
        F.coalesce(F.col("cnt") == F.floor(F.col("r") * F.col("cnt0")), F.lit(True)).alias("truncated"),
    )


def safe_identifiers(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.example.org"))
    return views.table(spark, d, "customer").select("c_custkey", safe_identifier(name).alias("identifier"))


# -- splitting and sampling ----------------------------------------------------


def hash_split_counts(spark: SparkSession, d: str) -> DataFrame:
    """Ten parts in one pass: the sizes of a 10 to 90 split at any cut."""
    bucket = sampling.key_bucket(views.PRICE_KEYS, sampling.PRICE_KEY_FACTORS, 10)
    return views.price(spark, d).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"))


def train_test_split(spark: SparkSession, d: str) -> DataFrame:
    train, test = sampling.train_test_split(views.price(spark, d), views.PRICE_KEYS)
    tagged = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return tagged.groupBy("part").agg(F.count("*").alias("rows"), F.round(F.sum("price"), 2).alias("total"))


def random_split(spark: SparkSession, d: str) -> DataFrame:
    """A seeded weighted split: the parts are disjoint and together are the input."""
    data = views.table(spark, d, "customer").select("c_custkey")
    small, rest = data.randomSplit([0.10, 0.90], seed=123)
    marked = small.withColumn("in_small", F.lit(1)).unionByName(rest.withColumn("in_small", F.lit(0)))
    per_key = marked.groupBy("c_custkey").agg(F.count("*").alias("times"), F.sum("in_small").alias("in_small"))
    return per_key.agg(
        F.count("*").alias("rows"),
        F.max("times").alias("most_parts"),
        F.abs(F.avg("in_small") - 0.10).between(0, 0.05).alias("near_weight"),
    )


def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    picked = sampling.sample_n(views.price(spark, d), 10, views.PRICE_KEYS, seed=7)
    return picked.select(*views.PRICE_KEYS, F.round("price", 10).alias("price"))


# -- aggregates ----------------------------------------------------------------


def group_count(spark: SparkSession, d: str) -> DataFrame:
    return views.loan(spark, d).groupBy("addr_state").agg(F.count("*").alias("count"))


def group_count_nonnull(spark: SparkSession, d: str) -> DataFrame:
    return views.loan(spark, d).groupBy("addr_state").agg(F.count("loan_status").alias("loans"))


def group_sum(spark: SparkSession, d: str) -> DataFrame:
    """Null inputs are skipped; a group of nulls only (S20) sums to null."""
    balance = F.when(F.col("c_nationkey") != 20, F.col("c_custkey"))
    return (
        views.table(spark, d, "customer")
        .groupBy(F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("addr_state"))
        .agg(F.sum(balance).alias("loans"))
    )


def topk_grouped_count(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: busiest month and origin on the first day of the week."""
    return (
        views.flights(spark, d)
        .where(F.col("dow") == 1)
        .groupBy("month", "origin")
        .agg(F.count("*").alias("total_flights"))
        .orderBy(F.col("total_flights").desc(), "month", "origin")
        .limit(20)
    )


def rmse_by_batch(spark: SparkSession, d: str) -> DataFrame:
    out = stats.rmse_by(views.pred(spark, d), "batch", "price", "prediction")
    return out.select("batch", F.round("rmse", 4).alias("rmse")).orderBy("batch")


def regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    scored = views.price(spark, d).withColumn("prediction", views.linear_score())
    out = stats.regression_metrics(scored, "price", "prediction")
    return out.select([F.round(c, 4).alias(c) for c in out.columns])


def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    return stats.corr_matrix(views.price(spark, d), CORR_COLUMNS, places=4)


def histogram_10(spark: SparkSession, d: str) -> DataFrame:
    scored = views.price(spark, d).withColumn("prediction", views.linear_score())
    out = stats.histogram(scored, ["price", "prediction"], HISTOGRAM_BINS)
    return out.select("column", "bin", F.round("bin_lo", 6).alias("bin_lo"), "n")


def pred_vs_true(spark: SparkSession, d: str) -> DataFrame:
    scored = views.price(spark, d).withColumn("prediction", views.linear_score())
    return scored.select(F.round("prediction", 8).alias("prediction"), F.round("price", 10).alias("price"))


# -- feature preparation -------------------------------------------------------


def max_scale(spark: SparkSession, d: str) -> DataFrame:
    columns = ["price", *views.PRICE_FEATURES]
    out = stats.max_scale(views.price(spark, d), columns)
    return out.select(*views.PRICE_KEYS, *[F.round(c, 6).alias(c) for c in columns])


def unpivot_features(spark: SparkSession, d: str) -> DataFrame:
    out = reshape.melt_features(views.price(spark, d), "price", views.PRICE_FEATURES)
    return out.groupBy("feature").agg(
        F.count("*").alias("rows"),
        F.round(F.avg("norm_value"), 6).alias("mean_value"),
        F.round(F.avg(F.col("norm_value") * F.col("price")), 4).alias("mean_product"),
    )


def local_trend(spark: SparkSession, d: str) -> DataFrame:
    columns = ["price", *views.PRICE_FEATURES]
    scaled = stats.max_scale(views.price(spark, d), columns)
    long = reshape.melt_features(scaled, "price", views.PRICE_FEATURES)
    out = stats.local_trend(long, "price", "norm_value", "feature")
    return out.select("feature", F.round("x", 2).alias("x"), F.round("trend", 3).alias("trend"))


def local_trend_robust(spark: SparkSession, d: str) -> DataFrame:
    """The trend after two robust steps over features in which some rows are far off."""
    columns = ["price", *views.PRICE_FEATURES]
    planted = views.price(spark, d).withColumn(
        "tax", F.when(F.col("l_orderkey") % 10 == 0, F.col("tax") + 50 * F.col("price")).otherwise(F.col("tax"))
    )
    long = reshape.melt_features(stats.max_scale(planted, columns), "price", views.PRICE_FEATURES)
    out = stats.local_trend(long, "price", "norm_value", "feature", robust_steps=ROBUST_STEPS)
    return out.select("feature", F.round("x", 2).alias("x"), F.round("trend", 3).alias("trend"))


QUERIES = {
    "scan_parquet": scan_parquet,
    "scan_csv_positional": scan_csv_positional,
    "table_files": table_files,
    "write_parquet_roundtrip": write_parquet_roundtrip,
    "ctas_partitioned": ctas_partitioned,
    "ctas_catalog": ctas_catalog,
    "project_columns": project_columns,
    "drop_label": drop_label,
    "head_scored": head_scored,
    "scalar_casts": scalar_casts,
    "rand_pair": rand_pair,
    "safe_identifier": safe_identifiers,
    "hash_split_counts": hash_split_counts,
    "train_test_split": train_test_split,
    "random_split": random_split,
    "sample_n": sample_rows,
    "group_count": group_count,
    "group_count_nonnull": group_count_nonnull,
    "group_sum": group_sum,
    "topk_grouped_count": topk_grouped_count,
    "rmse_by_batch": rmse_by_batch,
    "regression_metrics": regression_metrics,
    "corr_matrix": corr_matrix,
    "histogram_10": histogram_10,
    "pred_vs_true": pred_vs_true,
    "max_scale": max_scale,
    "unpivot_features": unpivot_features,
    "local_trend": local_trend,
    "local_trend_robust": local_trend_robust,
}


def _corr_sql() -> str:
    cells = [
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) + 0.0 AS corr FROM price"
        for a in CORR_COLUMNS
        for b in CORR_COLUMNS
    ]
    return with_(texts.PRICE, select=" UNION ALL ".join(cells))


def _histogram_sql() -> str:
    return with_(
        texts.PRICE,
        f"scored AS (SELECT price, {texts.SCORE} AS prediction FROM price)",
        "vals AS (SELECT 'price' AS col, price AS v FROM scored UNION ALL SELECT 'prediction', prediction FROM scored)",
        "lim AS (SELECT col, min(v) AS lo, max(v) AS hi FROM vals GROUP BY col)",
        "binned AS (SELECT vals.col, least(CAST(floor((v-lo)/((hi-lo)/10)) AS BIGINT), 9) AS bin, count(*) AS n "
        "FROM vals JOIN lim ON vals.col = lim.col GROUP BY 1, 2)",
        select="SELECT lim.col AS \"column\", b.bin, round(lo + b.bin*((hi-lo)/10), 6) AS bin_lo, "
        "coalesce(binned.n, 0) AS n FROM lim CROSS JOIN (SELECT unnest(range(10)) AS bin) b "
        "LEFT JOIN binned ON binned.col = lim.col AND binned.bin = b.bin",
    )


_SCALED = "scaled AS (SELECT " + ", ".join(
    [*views.PRICE_KEYS, *[f"{c}/(SELECT max({c}) FROM price) AS {c}" for c in CORR_COLUMNS]]
) + " FROM price)"


def _melted(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, price, {c} AS norm_value FROM {source}" for c in views.PRICE_FEATURES
    )


_SPREAD = "(n*sxx - sx*sx)"


def _trend_step_sql(step: int, rows: str) -> list[str]:
    """The trend over rows (feature, price, norm_value, weight), as common table expressions."""
    return [
        f"sums{step} AS MATERIALIZED (SELECT feature, least(CAST(floor(price*200) AS BIGINT), 199) AS bin, sum(weight) AS n, "
        "sum(weight*price) AS sx, sum(weight*norm_value) AS sy, sum(weight*price*price) AS sxx, "
        f"sum(weight*price*norm_value) AS sxy FROM {rows} GROUP BY 1, 2)",
        f"dist{step} AS (SELECT feature, i, abs(i*CAST(0.05 AS DOUBLE) - (bin + 0.5)/200)/CAST(0.2 AS DOUBLE) AS u, "
        f"n, sx, sy, sxx, sxy FROM sums{step} CROSS JOIN range(21) AS r(i))",
        f"w{step} AS (SELECT *, CASE WHEN u < 1 THEN pow(1 - pow(u, 3), 3) ELSE 0 END AS k FROM dist{step})",
        f"agg{step} AS (SELECT feature, i, sum(k*n) AS n, sum(k*sx) AS sx, sum(k*sy) AS sy, sum(k*sxx) AS sxx, "
        f"sum(k*sxy) AS sxy FROM w{step} GROUP BY feature, i HAVING sum(k*n) > 0)",
        f"new{step} AS (SELECT feature, i, CASE WHEN {_SPREAD} > 1e-9 THEN sy/n + (n*sxy - sx*sy)/{_SPREAD}"
        f"*(i*CAST(0.05 AS DOUBLE) - sx/n) ELSE sy/n END AS trend FROM agg{step})",
        f"trend{step} AS MATERIALIZED ("
        + (
            f"SELECT o.feature, o.i, coalesce(t.trend, o.trend) AS trend FROM trend{step - 1} o LEFT JOIN new{step} t "
            "ON o.feature = t.feature AND o.i = t.i)"
            if step
            else "SELECT * FROM new0)"
        ),
    ]


def _weighed_sql(step: int) -> list[str]:
    """Rows weighed by their distance from the trend of a step."""
    return [
        f"placed{step} AS (SELECT feature, price, norm_value, least(greatest(floor(price*20), 0), 19) AS low FROM melted)",
        f"far{step} AS MATERIALIZED (SELECT p.feature, price, norm_value, norm_value - (coalesce(a.trend, b.trend) + "
        "(coalesce(b.trend, a.trend) - coalesce(a.trend, b.trend))*(price*20 - low)) AS r "
        f"FROM placed{step} p LEFT JOIN trend{step} a ON a.feature = p.feature AND a.i = low "
        f"LEFT JOIN trend{step} b ON b.feature = p.feature AND b.i = low + 1)",
        f"bins{step} AS (SELECT feature, CASE WHEN r = 0 THEN -1000000 ELSE floor(log2(abs(r))*64) END AS bin, "
        f"count(*) AS n, sum(abs(norm_value)) AS y FROM far{step} WHERE r IS NOT NULL GROUP BY 1, 2)",
        f"upto{step} AS (SELECT feature, bin, sum(n) OVER (PARTITION BY feature ORDER BY bin) AS upto, "
        "sum(n) OVER (PARTITION BY feature) AS total, "
        f"sum(y) OVER (PARTITION BY feature)/sum(n) OVER (PARTITION BY feature) AS mean_y FROM bins{step})",
        f"scale{step} AS (SELECT feature, greatest(6*CASE WHEN min(bin) = -1000000 THEN 0 ELSE pow(2, (min(bin) + 1)/64) END, "
        f"max(mean_y)*1e-9) AS s FROM upto{step} WHERE 2*upto >= total GROUP BY feature)",
        f"weighed{step} AS MATERIALIZED (SELECT f.feature, price, norm_value, CASE WHEN s = 0 THEN 1 WHEN abs(r) < s "
        f"THEN pow(1 - (r/s)*(r/s), 2) ELSE 0 END AS weight FROM far{step} f JOIN scale{step} z ON z.feature = f.feature)",
    ]


def _robust_trend_sql() -> str:
    columns = ", ".join("tax + CASE WHEN l_orderkey % 10 = 0 THEN 50*price ELSE 0 END AS tax" if c == "tax" else c for c in CORR_COLUMNS)
    tops = ", ".join(f"{c}/(SELECT max({c}) FROM planted) AS {c}" for c in CORR_COLUMNS)
    parts = [
        texts.PRICE,
        f"planted AS MATERIALIZED (SELECT {columns} FROM price)",
        f"scaled AS MATERIALIZED (SELECT {tops} FROM planted)",
        f"melted AS MATERIALIZED ({_melted('scaled')})",
        "evenly AS (SELECT *, 1 AS weight FROM melted)",
        *_trend_step_sql(0, "evenly"),
    ]
    for step in range(1, ROBUST_STEPS + 1):
        parts += [*_weighed_sql(step - 1), *_trend_step_sql(step, f"weighed{step - 1}")]
    return with_(
        *parts,
        select=f"SELECT feature, round(i*CAST(0.05 AS DOUBLE), 2) AS x, round(trend, 3) AS trend FROM trend{ROBUST_STEPS}",
    )


ORACLES = {
    "scan_parquet": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "scan_csv_positional": """SELECT CAST(year(l_shipdate) AS BIGINT) AS "Year",
        CAST(month(l_shipdate) AS BIGINT) AS "Month", CAST(isodow(l_shipdate) AS BIGINT) AS "DayOfWeek",
        l_suppkey % 25 AS "Origin", l_returnflag AS "UniqueCarrier", count(*) AS flights,
        count(CASE WHEN l_linenumber <> 1 THEN l_quantity END) AS with_distance,
        sum(CASE WHEN l_linenumber <> 1 THEN l_quantity END) AS distance,
        max(l_orderkey) AS top_number, CAST(0 AS BIGINT) AS tails
        FROM lineitem GROUP BY 1, 2, 3, 4, 5""",
    "table_files": with_(
        texts.FLIGHTS, select="SELECT DISTINCT origin, true AS has_files, true AS has_bytes FROM flights"
    ),
    "write_parquet_roundtrip": with_(texts.LOAN, select="SELECT * FROM loan"),
    "ctas_partitioned": with_(
        texts.FLIGHTS, select="SELECT origin, dow, count(*) AS flights FROM flights GROUP BY origin, dow"
    ),
    "ctas_catalog": with_(
        texts.FLIGHTS,
        select="SELECT dow, count(*) AS flights, max(origin) AS top_origin FROM flights GROUP BY dow",
    ),
    "project_columns": with_(texts.LOAN, select="SELECT addr_state, loan_status FROM loan"),
    "drop_label": with_(
        texts.PRICE,
        select="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(qty, 6) AS qty, "
        "round(ext, 6) AS ext, round(disc, 6) AS disc, round(tax, 6) AS tax FROM price",
    ),
    "head_scored": with_(
        texts.PRICE,
        select=f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({texts.SCORE}, 8) AS prediction "
        "FROM price ORDER BY 1, 2, 3, 4 LIMIT 10",
    ),
    "scalar_casts": with_(
        texts.LOAN_BY_STATE,
        select="SELECT addr_state, CAST(trunc(cnt * CAST(0.37 AS DOUBLE)) AS BIGINT) AS part, "
        "CAST(trunc(cnt * CAST(-0.37 AS DOUBLE)) AS BIGINT) AS negative_part, "
        "cnt * CAST(2500 AS DOUBLE) AS amount FROM loan_by_state",
    ),
    "rand_pair": with_(
        texts.LOAN_BY_STATE,
        select="SELECT addr_state, true AS same_draw, true AS null_kept, true AS truncated FROM loan_by_state",
    ),
    "safe_identifier": "SELECT c_custkey, replace(replace(lower(replace(c_name, '#', '.')) || '@mail.example.org', "
    "'.', '_'), '@', '_') AS identifier FROM customer",
    "hash_split_counts": "SELECT (l_orderkey*31 + l_linenumber*17 + l_partkey*7 + l_suppkey) % 10 AS bucket, "
    "count(*) AS rows FROM lineitem GROUP BY 1",
    "train_test_split": with_(
        texts.PRICE,
        select=f"SELECT CASE WHEN {texts.IS_TEST} THEN 'test' ELSE 'train' END AS part, count(*) AS rows, "
        "round(sum(price), 2) AS total FROM price GROUP BY 1",
    ),
    "random_split": "SELECT count(*) AS rows, CAST(1 AS BIGINT) AS most_parts, true AS near_weight FROM customer",
    "sample_n": with_(
        texts.PRICE,
        select="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(price, 10) AS price FROM price "
        "ORDER BY md5(concat_ws('|', '7', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 2, 3, 4 LIMIT 10",
    ),
    "group_count": with_(texts.LOAN, select='SELECT addr_state, count(*) AS "count" FROM loan GROUP BY addr_state'),
    "group_count_nonnull": with_(
        texts.LOAN, select="SELECT addr_state, count(loan_status) AS loans FROM loan GROUP BY addr_state"
    ),
    "group_sum": "SELECT concat('S', CAST(c_nationkey AS VARCHAR)) AS addr_state, "
    "CAST(sum(CASE WHEN c_nationkey <> 20 THEN c_custkey END) AS BIGINT) AS loans FROM customer GROUP BY 1",
    "topk_grouped_count": with_(
        texts.FLIGHTS,
        select="SELECT month, origin, count(*) AS total_flights FROM flights WHERE dow = 1 "
        "GROUP BY month, origin ORDER BY total_flights DESC, month, origin LIMIT 20",
    ),
    "rmse_by_batch": with_(
        texts.PRED,
        select="SELECT batch, round(sqrt(avg((price-prediction)*(price-prediction))), 4) AS rmse FROM pred GROUP BY batch",
    ),
    "regression_metrics": with_(
        texts.PRICE,
        f"scored AS (SELECT price, {texts.SCORE} AS prediction FROM price)",
        select="SELECT round(avg((price-prediction)*(price-prediction)), 4) AS test_mse, "
        "round(avg(abs(price-prediction)), 4) AS test_mae, "
        "round(sqrt(avg((price-prediction)*(price-prediction))), 4) AS test_rmse, "
        "round(1 - sum((price-prediction)*(price-prediction))/(var_pop(price)*count(*)), 4) AS test_r2 FROM scored",
    ),
    "corr_matrix": _corr_sql(),
    "histogram_10": _histogram_sql(),
    "pred_vs_true": with_(
        texts.PRICE, select=f"SELECT round({texts.SCORE}, 8) AS prediction, round(price, 10) AS price FROM price"
    ),
    "max_scale": with_(
        texts.PRICE,
        _SCALED,
        select="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in CORR_COLUMNS)
        + " FROM scaled",
    ),
    "unpivot_features": with_(
        texts.PRICE,
        f"melted AS ({_melted('price')})",
        select="SELECT feature, count(*) AS rows, round(avg(norm_value), 6) AS mean_value, "
        "round(avg(norm_value*price), 4) AS mean_product FROM melted GROUP BY feature",
    ),
    "local_trend": with_(
        texts.PRICE,
        _SCALED,
        f"melted AS ({_melted('scaled')})",
        "sums AS (SELECT feature, least(CAST(floor(price*200) AS BIGINT), 199) AS bin, count(*) AS n, sum(price) AS sx, "
        "sum(norm_value) AS sy, sum(price*price) AS sxx, sum(price*norm_value) AS sxy FROM melted GROUP BY 1, 2)",
        "grid AS (SELECT i*CAST(0.05 AS DOUBLE) AS x FROM range(21) AS r(i))",
        "dist AS (SELECT feature, x, abs(x - (bin + 0.5)/200)/CAST(0.2 AS DOUBLE) AS u, n, sx, sy, sxx, sxy "
        "FROM sums CROSS JOIN grid)",
        "w AS (SELECT *, CASE WHEN u < 1 THEN pow(1 - pow(u, 3), 3) ELSE 0 END AS k FROM dist)",
        "agg AS (SELECT feature, x, sum(k*n) AS n, sum(k*sx) AS sx, sum(k*sy) AS sy, sum(k*sxx) AS sxx, "
        "sum(k*sxy) AS sxy FROM w GROUP BY feature, x HAVING sum(k*n) > 0)",
        select=f"SELECT feature, round(x, 2) AS x, round(CASE WHEN {_SPREAD} > 1e-9 THEN "
        f"sy/n + (n*sxy - sx*sy)/{_SPREAD}*(x - sx/n) ELSE sy/n END, 3) AS trend FROM agg",
    ),
    "local_trend_robust": _robust_trend_sql(),
}
