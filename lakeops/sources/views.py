"""The workload tables, derived from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRICE_FEATURES = ["ext", "disc", "tax", "qty"]
PRICE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# The linear scorer used wherever an exact expectation is wanted.
SCORER_INTERCEPT = 0.5
SCORER_WEIGHTS = {"ext": 0.99, "disc": -53.0, "tax": 51.0}

# The upsert source; S7 is deleted before the upsert, S20 becomes null.
MERGE_ROWS = [("S7", 1000000), ("S3", 25), ("S20", None), ("ZZ", 9)]
LOAN_SCHEMA = "addr_state string, cnt long"

DRIFT_ORDER = ["disc", "ext", "tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("loan_id"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("addr_state"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("loan_status"),
    )


def loan_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan(spark, sf_dir).groupBy("addr_state").agg(F.count("*").alias("cnt"))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.month("l_shipdate").cast("long").alias("month"),
        (F.weekday("l_shipdate") + 1).cast("long").alias("dow"),
        (F.col("l_suppkey") % 25).alias("origin"),
    )


def price(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").alias("qty"),
        (ext / 1000).alias("ext"),
        disc.alias("disc"),
        tax.alias("tax"),
        (ext * (1 - disc) * (1 + tax) / 1000).alias("price"),
    )


def linear_score(weights: dict[str, float] = SCORER_WEIGHTS, intercept: float = SCORER_INTERCEPT) -> Column:
    score = F.lit(intercept)
    for name, weight in weights.items():
        score = score + F.lit(weight) * F.col(name)
    return score


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five scoring batches: 0 and 1 unchanged, then disc, ext and tax zeroed in turn."""
    batch = F.col("batch")
    rows = price(spark, sf_dir).withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))))
    for first, name in enumerate(DRIFT_ORDER, start=2):
        rows = rows.withColumn(name, F.when(batch >= first, F.lit(0.0)).otherwise(F.col(name)))
    return rows.select("batch", "price", linear_score().alias("prediction"))
